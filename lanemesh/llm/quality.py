"""Quality rules with adaptive thresholds.

Fixed base rules fail a document with under 10 words or with over 20 % of its words in repeated
five-word windows. The other limits come from the data: quantile sketches of four ratios per
language and source, each limit `reach` spreads outside the quartiles. A sketch is a histogram over
logarithmic buckets (1 % relative error), kept as rows (group, ratio, bucket, count); two sketches
merge by adding counts, exactly, so results don't depend on partitions or reruns. The limits of every
language and source are its own sketch's, drawn towards its language's as if these stood for `prior`
documents more, and a language's are so drawn towards those of all documents.

Defined cases: a null text has no words and fails the base rules; null languages and sources are
groups of their own; ratios of documents without words are 0 and don't enter the sketches; repeated
rows count repeatedly and come out alike; a ratio that equals its limit passes; texts of any length are
measured whole; empty tables give empty ones; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialized, small_batches

BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
RUN = 5
#: Ratio, its expression, the least spread its quartiles count as, and whether too low fails as well.
RATIOS = (
    ("word_length", "try_divide(word_chars, n_words)", 0.3, True),
    ("symbols", "try_divide(n_symbols, n_words)", 0.02, False),
    ("dup_lines", "try_divide(n_dup_lines, n_lines)", 0.05, False),
    ("repeats", "try_divide(n_repeat_words, n_words)", 0.03, False),
)
GAMMA = 1.02


def measures(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = 0
    if len(words) > RUN:
        windows = list(zip(*(words[k:] for k in range(RUN))))
        if len(set(windows)) < len(windows):
            counts, covered = Counter(windows), 0
            for at, window in enumerate(windows):
                if counts[window] > 1:
                    repeated += at + RUN - max(covered, at)
                    covered = at + RUN
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures; one pass without a shuffle."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(t.as_py() or "") for t in batch.column("text")]
            cols = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "lang", "source")] + cols, names=["doc_id", "lang", "source", *names])

    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return source.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{n} long" for n in names))


def sketches(found: DataFrame) -> DataFrame:
    """lang, source, ratio, bucket, n: mergeable by summing n."""
    ratios = F.array(*(F.struct(F.lit(name).alias("ratio"), F.expr(f"coalesce({expr}, 0D)").alias("x")) for name, expr, _, _ in RATIOS))
    rows = found.where("n_words > 0").select("lang", "source", F.inline(ratios))
    bucket = F.when(F.col("x") > 0, F.ceil(F.log("x") / math.log(GAMMA))).otherwise(F.lit(-(1 << 40))).alias("bucket")
    return rows.groupBy("lang", "source", "ratio", bucket).agg(F.count(F.lit(1)).alias("n"))


def limits(sketch: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """keys, ratio, rows, low, high from a sketch merged over all columns but `keys`."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "ratio")
    value = F.when(F.col("bucket") < -(1 << 39), 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (1 + GAMMA))
    ranked = merged.withColumn("through", F.sum("n").over(group.orderBy("bucket"))).withColumn("rows", F.sum("n").over(group)).withColumn("x", value)
    at = lambda q: F.min(F.when(F.col("through") >= F.col("rows") * q, F.col("x")))
    quarts = ranked.groupBy(*keys, "ratio").agg(F.first("rows").alias("rows"), at(0.25).alias("q1"), at(0.75).alias("q3"))
    floor = F.create_map(*(x for name, _, least, _ in RATIOS for x in (F.lit(name), F.lit(least))))[F.col("ratio")]
    spread = F.greatest(F.col("q3") - F.col("q1"), floor) * reach
    return quarts.select(*keys, "ratio", "rows", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


def judged(docs: DataFrame, reach: float = 8.0, prior: float = 20.0) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of `docs`."""
    found = materialized(measured(docs), "quality-measures")
    sketch = materialized(sketches(found), "quality-sketches")
    groups = sketch.select("lang", "source").distinct()
    tables = [limits(sketch, ["lang", "source"], reach), limits(sketch, ["lang"], reach), limits(sketch, [], reach)]
    wide = []
    for n, (limit, keys) in enumerate(zip(tables, (["lang", "source"], ["lang"], []))):
        per = limit.groupBy(*keys).agg(F.first("rows").alias(f"rows{n}"), *(F.max(F.when(F.col("ratio") == r, F.struct("low", "high"))).alias(f"{r}{n}") for r, *_ in RATIOS))
        wide.append(per.select(*(F.col(k).alias(f"{k}{n}") for k in keys), *(c for c in per.columns if c not in keys)))
    same = lambda n, *keys: [F.col(k).eqNullSafe(F.col(f"{k}{n}")) for k in keys]
    # wide[2] is a single row.
    use = groups.join(wide[0], same(0, "lang", "source"), "left").join(wide[1], same(1, "lang"), "left").join(wide[2], F.lit(True), "left")
    drawn = lambda n, r, part, to: (F.col(f"rows{n}") * F.col(f"{r}{n}")[part] + F.lit(prior) * to) / (F.col(f"rows{n}") + F.lit(prior))
    limit = lambda r, part: drawn(0, r, part, drawn(1, r, part, F.col(f"{r}2")[part])).alias(part)
    pick = lambda r: F.struct(limit(r, "low"), limit(r, "high")).alias(f"limit_{r}")
    use = materialized(use.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *(pick(r) for r, *_ in RATIOS)), "quality-limits")
    joined = found.join(use, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    within = F.lit(True)
    for name, expr, _, both in RATIOS:
        x, limit = F.expr(f"coalesce({expr}, 0D)"), F.col(f"limit_{name}")
        within = within & F.coalesce((x <= limit["high"]) & ((x >= limit["low"]) if both else F.lit(True)), F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & within).alias("kept"))


#: The op7 query's rows in DuckDB SQL.
ORACLE = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2), (3), (4)) AS o(k) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
r AS (SELECT doc_id, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS ratio,
        unnest([word_chars / n_words, n_symbols / n_words, n_dup_lines / n_lines, n_repeat_words / n_words]) AS x FROM m WHERE n_words > 0),
s AS (SELECT lang, source, ratio, CASE WHEN x > 0 THEN ceil(ln(x) / ln(1.02::DOUBLE))::BIGINT ELSE -1099511627776 END AS bucket, count(*) AS n FROM r GROUP BY ALL),
a AS (SELECT 0 AS level, lang, source, ratio, bucket, n FROM s UNION ALL SELECT 1, lang, NULL, ratio, bucket, sum(n) FROM s GROUP BY ALL UNION ALL SELECT 2, NULL, NULL, ratio, bucket, sum(n) FROM s GROUP BY ALL),
p AS (SELECT level, lang, source, ratio, CASE WHEN bucket < 0 AND bucket < -549755813888 THEN 0 ELSE 2 * pow(1.02::DOUBLE, bucket) / 2.02::DOUBLE END AS x,
        sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bucket) AS through, sum(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM a),
q AS (SELECT level, lang, source, ratio, any_value(total)::DOUBLE AS total, min(x) FILTER (through >= total * 0.25) AS q1, min(x) FILTER (through >= total * 0.75) AS q3 FROM p GROUP BY level, lang, source, ratio),
b AS (SELECT *, q1 - 8 * greatest(q3 - q1, least) AS low, q3 + 8 * greatest(q3 - q1, least) AS high
      FROM q JOIN (VALUES ('word_length', 0.3::DOUBLE), ('symbols', 0.02::DOUBLE), ('dup_lines', 0.05::DOUBLE), ('repeats', 0.03::DOUBLE)) AS f(name, least) ON name = ratio),
v AS (SELECT o.lang, o.source, o.ratio,
        (o.total * o.low + 20 * ((u.total * u.low + 20 * e.low) / (u.total + 20))) / (o.total + 20) AS low, (o.total * o.high + 20 * ((u.total * u.high + 20 * e.high) / (u.total + 20))) / (o.total + 20) AS high
      FROM b o JOIN b u ON u.level = 1 AND u.ratio = o.ratio AND u.lang IS NOT DISTINCT FROM o.lang JOIN b e ON e.level = 2 AND e.ratio = o.ratio WHERE o.level = 0),
h AS (SELECT DISTINCT doc_id FROM r JOIN v ON r.ratio = v.ratio AND r.lang IS NOT DISTINCT FROM v.lang AND r.source IS NOT DISTINCT FROM v.source
      WHERE x > high OR (r.ratio = 'word_length' AND x < low)),
j AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM h) AS kept FROM j
"""
