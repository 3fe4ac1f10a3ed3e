"""Secret scan with multipart credential linking. DataFrame functions only.

Three strong patterns are always reported: assignments (`assign`), access identifiers (`access`) and
long hexadecimal strings (`hex`). Three weak ones are candidates only: account identifiers (`ident`),
mixed random-looking strings (`blob`) and endpoints (`endpoint`). A weak candidate is reported when a
complementary part begins within `scope` code points of its own beginning: an identifier needs a
secret, a random string needs an identifier, an endpoint needs either. The linking is an interval
join on (document, scope bin) that only asks whether such a part exists, so no pairs are made.

Positions come from the lengths of what a pattern splits a text into and of what it matches, summed
up to each match. They count code points, ends exclusive. Letters in key words match in either case
within ASCII.

Defined cases: a null text counts as empty; texts of any length are scanned whole; repeated rows
give repeated results; rows with a null id are scanned like others; equal spans of one kind can't
occur, spans of several kinds may overlap; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialized, text_or_empty

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENT = r"""((?i:access_?key_?id|client_?id|user_?name|account_?id|login))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
BLOB = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"(?i:https?|jdbc:[a-z]{1,16}|mongodb|postgres|mysql|redis|amqp)://[A-Za-z0-9.:@/_-]{4,}"
#: Kind, pattern, order among spans with one start.
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("ident", IDENT), ("blob", BLOB), ("endpoint", ENDPOINT))
STRONG = ("assign", "access", "hex")
#: Weak kind to the kinds of which one has to be near.
NEEDS = {"ident": ("assign", "hex", "blob"), "blob": ("access", "ident"), "endpoint": ("assign", "access", "hex", "ident")}


def _parts(kind: str, pattern: str, cuts: Column) -> Column:
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.transform(found, lambda m: F.length(F.regexp_extract(m, pattern, 2)) >= 8) if kind == "assign" else F.transform(found, lambda m: F.lit(True))
    zipped = F.arrays_zip(F.transform(cuts, lambda c: F.length(c)).alias("gap"), F.transform(found, lambda m: F.length(m)).alias("len"), value.alias("good"))
    return F.when(F.size(cuts) > 1, F.transform(zipped, lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), z["gap"].cast("long").alias("gap"), z["len"].cast("long").alias("len"), z["good"].alias("good"))))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), kind, start, end: all candidates, weak ones included."""
    df = docs.select("doc_id", text_or_empty().alias("text")).withColumn("mark", F.xxhash64("text"))
    cut = lambda pattern: F.split("text", pattern, -1)
    for kind, pattern in KINDS[:4]:
        df = df.withColumn(f"c_{kind}", cut(pattern))
    strong_or_ident = F.lit(False)
    for kind, _ in KINDS[:4]:
        strong_or_ident = strong_or_ident | (F.size(f"c_{kind}") > 1)
    df = df.withColumn("any", strong_or_ident).where("any")
    df = df.withColumn("c_blob", F.when((F.size("c_access") > 1) | (F.size("c_ident") > 1), cut(BLOB))).withColumn("c_endpoint", cut(ENDPOINT))
    arrays = [F.coalesce(_parts(kind, pattern, F.col(f"c_{kind}")), F.array().cast("array<struct<kind:string,i:int,gap:bigint,len:bigint,good:boolean>>")) for kind, pattern in KINDS]
    parts = df.select("doc_id", "mark", F.inline(F.concat(*arrays))).distinct()
    before = W.partitionBy("doc_id", "mark", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(before)
    return parts.withColumn("end", end).where("len is not null and good").select("doc_id", "mark", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def linked(found: DataFrame, scope: int) -> DataFrame:
    """The weak rows of `found` that have a complementary part in scope."""
    needs = F.create_map(*(x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    weak = found.where(~F.col("kind").isin(*STRONG)).withColumn("bin", F.expr(f"start div {scope}")).withColumn("needs", needs[F.col("kind")])
    near = found.where("kind <> 'endpoint'").select(
        F.col("doc_id").alias("n_doc"), F.col("mark").alias("n_mark"), F.col("kind").alias("n_kind"), F.col("start").alias("n_start"),
        F.explode(F.sequence(F.expr(f"start div {scope} - 1"), F.expr(f"start div {scope} + 1"))).alias("n_bin"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("n_doc")) & (F.col("mark") == F.col("n_mark")) & (F.col("bin") == F.col("n_bin"))
    close = (F.abs(F.col("start") - F.col("n_start")) <= scope) & F.array_contains(F.col("needs"), F.col("n_kind"))
    return weak.join(near, on & close, "left_semi").select(found.columns)


def secret_report(docs: DataFrame, scope: int = 400) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for every row of `docs`."""
    found = materialized(spans(docs), "secret-spans")
    kept = found.where(F.col("kind").isin(*STRONG)).unionByName(linked(found, scope))
    order = F.create_map(*(x for n, (k, _) in enumerate(KINDS) for x in (F.lit(k), F.lit(n))))
    item = F.struct("start", order[F.col("kind")].alias("o"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    count = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}")
    per = kept.groupBy("doc_id", "mark").agg(
        *map(count, STRONG), F.count(F.when(~F.col("kind").isin(*STRONG), 1)).alias("n_linked"),
        F.sort_array(F.collect_list(item)).alias("all"),
    )
    joined_up = lambda a: F.array_join(F.transform(a, lambda x: x["s"]), ",")
    per = per.select(
        F.col("doc_id").alias("p_doc"), F.col("mark").alias("p_mark"), *(f"n_{k}" for k in STRONG), "n_linked", joined_up(F.col("all")).alias("spans"),
        joined_up(F.filter("all", lambda x: x["o"] < len(STRONG))).alias("base"),
    )
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("mark"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(per, F.col("doc_id").eqNullSafe(F.col("p_doc")) & (F.col("mark") == F.col("p_mark")), "left").select(
        "doc_id", *(zero(f"n_{k}") for k in STRONG), F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_linked")
    )


#: The op6 query's rows in DuckDB SQL: a pattern's gaps and matches by turns, their lengths summed up.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k(kind, o, pattern) AS (VALUES
  ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
  ('access', 1, 'AKIA[A-Z0-9]{12,}'), ('hex', 2, '[0-9a-f]{32,}'),
  ('ident', 3, '(?i:access_?key_?id|client_?id|user_?name|account_?id|login)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9_.@-]{4,}'),
  ('blob', 4, '[A-Za-z0-9+/_-]{20,}'), ('endpoint', 5, '(?i:https?|jdbc:[a-z]{1,16}|mongodb|postgres|mysql|redis|amqp)://[A-Za-z0-9.:@/_-]{4,}')),
m AS (SELECT doc_id, kind, o, regexp_extract_all(t, pattern) AS found, string_split_regex(t, pattern) AS gaps FROM d, k),
e AS (SELECT doc_id, kind, o, found[i] AS m, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(found[1:i], lambda x: length(x))) AS stop
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0)),
s AS (SELECT doc_id, kind, o, stop - length(m) AS start, stop FROM e
      WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, '^[^:=]*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8
                      WHEN 'blob' THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') ELSE true END),
n(kind, need) AS (VALUES ('ident', ['assign', 'hex', 'blob']), ('blob', ['access', 'ident']), ('endpoint', ['assign', 'access', 'hex', 'ident'])),
u AS (SELECT * FROM s WHERE o < 3 UNION ALL
      SELECT s.* FROM s JOIN n ON n.kind = s.kind WHERE EXISTS (SELECT 1 FROM s p WHERE p.doc_id = s.doc_id AND list_contains(n.need, p.kind) AND abs(p.start - s.start) <= 400)),
f AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (o >= 3) AS n_linked,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS base
      FROM u GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0)::BIGINT AS n_linked
FROM d LEFT JOIN f ON f.doc_id = d.doc_id
"""
