"""Line dedup over overlapping three-line windows. DataFrame functions only.

Each run of three consecutive lines is hashed (two 64-bit hashes with different seeds). Windows that
occur more than once anywhere keep their first occurrence, by (doc_id, mark, line); every later one marks
its three lines. Marked windows of a document are merged into runs of lines, which are cut out.

Only the hashes and positions are shuffled for the search. First occurrences are found by a
combinable minimum; windows that a thousandth of all rows have are salted for the join back to their
positions, so that no window puts its rows into one task.

Defined cases: lines are what `\n` separates, compared exactly; windows of three blank lines are
ignored; a document of one or two lines has no window and stays as it is; a null text stays null and
an empty one empty; rows with a null doc_id stay as they are; rows that repeat a doc_id and text are
one document and all come out alike; different texts of one doc_id are documents of their own, in the
order of a hash of the text (`mark`, 0 where no doc_id has several); texts of any length are cut whole;
a document that loses all its lines comes out with an empty text (`drop_emptied` removes it); an empty
table gives an empty one; further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import dropped, materialized, spread_join

WINDOW = 3


def mark_of(docs: DataFrame) -> Column:
    """What tells the texts of one doc_id apart: nothing, in tables where each has one text."""
    hashes = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    return F.lit(0).cast("long") if hashes.where("a <> b").isEmpty() else F.xxhash64("text")


def line_windows(docs: DataFrame, mark: Column) -> DataFrame:
    """doc_id, mark, pos, h1, h2: a row for each window that has a line with a word."""
    lines = docs.where(F.col("doc_id").isNotNull()).select("doc_id", mark.alias("mark"), F.split("text", "\n", -1).alias("l")).where(F.size("l") >= WINDOW)
    hashed = lines.select(
        "doc_id", "mark",
        F.transform("l", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"), x.rlike(r"[^\x20\x09-\x0D]").alias("word"))).alias("l"),
    )
    at = lambda i, k: F.element_at("l", (i + k).cast("int"))
    windows = F.transform(
        F.sequence(F.lit(1), F.size("l") - (WINDOW - 1)),
        lambda i: F.struct(
            (i - 1).cast("int").alias("pos"),
            F.xxhash64(*(at(i, k)["a"] for k in range(WINDOW))).alias("h1"),
            F.xxhash64(*(at(i, k)["b"] for k in range(WINDOW))).alias("h2"),
            (at(i, 0)["word"] | at(i, 1)["word"] | at(i, 2)["word"]).alias("word"),
        ),
    )
    return hashed.select("doc_id", "mark", F.inline(windows)).where("word").drop("word")


def repeated_runs(docs: DataFrame, mark: Column) -> DataFrame:
    """doc_id, mark, runs (written): sorted, disjoint structs (a, b) of first and last marked line."""
    windows = materialized(line_windows(docs, mark), "line-windows")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "mark", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first", "n")
    found = spread_join(windows, first, {"h1": "f1", "h2": "f2"}, "first", "n", windows.count(), F.struct("doc_id", "mark", "pos"))
    marked = found.where(F.struct("doc_id", "mark", "pos") > F.col("first")).select("doc_id", "mark", "pos").distinct()
    by_pos = W.partitionBy("doc_id", "mark").orderBy("pos")
    runs = (
        marked.withColumn("new", (F.col("pos") - F.lag("pos", 1, -WINDOW - 1).over(by_pos) > WINDOW).cast("int"))
        .withColumn("run", F.sum("new").over(by_pos))
        .groupBy("doc_id", "mark", "run").agg(F.min("pos").alias("a"), (F.max("pos") + (WINDOW - 1)).alias("b"))
        .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))
    )
    runs = materialized(runs, "line-runs")
    dropped(windows)
    return runs


def line_deduped(docs: DataFrame, drop_emptied: bool = False, counts: bool = False) -> DataFrame:
    """`docs` with the repeated windows cut out of `text`; `counts` adds n_lines and n_removed."""
    mark = mark_of(docs.select("doc_id", "text"))
    runs = repeated_runs(docs.select("doc_id", "text"), mark).select(F.col("doc_id").alias("run_doc"), F.col("mark").alias("run_mark"), "runs")
    # Columns go by their places meanwhile, so no name of theirs can clash.
    rows = docs.toDF(*(f"d{k}" for k in range(len(docs.columns))))
    doc_id, text = (f"d{docs.columns.index(c)}" for c in ("doc_id", "text"))
    joined = rows.withColumn("text", F.col(text)).withColumn("mark", mark).join(runs, (F.col(doc_id) == F.col("run_doc")) & (F.col("mark") == F.col("run_mark")), "left").withColumn("lines", F.split(text, "\n", -1))
    n = F.size("lines")
    gap = lambda i: F.struct(  # noqa: E731  the lines between run i - 1 and run i
        F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("runs", F.greatest(i, F.lit(1)).cast("int"))["b"] + 1).alias("a"),
        F.when(i == F.size("runs"), n).otherwise(F.try_element_at("runs", (i + 1).cast("int"))["a"]).alias("b"),
    )
    gaps = F.transform(F.sequence(F.lit(0), F.size("runs")), gap)
    kept = F.flatten(F.transform(F.filter(gaps, lambda g: g["b"] > g["a"]), lambda g: F.slice("lines", g["a"] + 1, g["b"] - g["a"])))
    joined = joined.withColumn("kept", F.when(F.col("runs").isNotNull(), kept))
    if drop_emptied:
        joined = joined.where(F.col("kept").isNull() | (F.size("kept") > 0))
    removed = F.coalesce(n - F.size("kept"), F.lit(0)).cast("long")
    left = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col(text))
    return joined.select(
        *((left if f"d{k}" == text else F.col(f"d{k}")).alias(c) for k, c in enumerate(docs.columns)),
        *([F.when(F.col(text).isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines"), removed.alias("n_removed")] if counts else []),
    )


#: The op5 query's rows in DuckDB SQL; windows are compared as text there.
ORACLE = r"""
WITH l AS (SELECT doc_id, i - 1 AS pos, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
             FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
w AS (SELECT doc_id, pos, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS win FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM w
      WHERE win IS NOT NULL AND regexp_matches(win, '[^\x20\x09-\x0D]')),
m AS (SELECT DISTINCT doc_id, pos + k AS pos FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE nth > 1),
r AS (SELECT l.doc_id, count(*) AS n_lines, count(m.pos) AS n_removed,
        coalesce(string_agg(CASE WHEN m.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS text
      FROM l LEFT JOIN m ON l.doc_id = m.doc_id AND l.pos = m.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(r.n_lines, 0)::BIGINT AS n_lines, coalesce(r.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(r.text, '')) AS kept_sha256
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""
