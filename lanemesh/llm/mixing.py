"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

Every document has a fixed 60-bit hash of its id. Words are summed by source and hash bucket; the
bucket in which a source's budget runs out is refined into 4,096 finer ones, five times over, until
its buckets are single hash values. A document is then taken if its hash lies below its source's
threshold, so nothing is sorted and a smaller budget always takes a subset of a larger one's rows.
Sources have to be few enough for one task to hold a row of each.

Defined cases: texts of any length are counted whole; a null text has size 0 (taken 0); a null source is a source of its own that comes
last; a null id hashes like an empty one; rows with equal ids are taken or left together; sources
without words and empty tables give targets of 0; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialized, text_or_empty

#: Bits of the hash that each level of histograms resolves, from the top.
LEVELS = (48, 36, 24, 12, 0)


def id_hash(name: str = "doc_id") -> Column:
    """60 bits of the MD5 of the id as text, as a non-negative long."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(name).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), id_hash().alias("h"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """source, source_size, target, repeats (whole passes), budget (words of the last, partial pass).

    Sharing, cutting at `most` times a source's size and resharing until none is above ends where
    every source gets min(most * size, level * weight) for one common level. With the sources in
    order of cap by weight the capped ones come first, so running sums give the level directly.
    The windows see one row a source.
    """
    by_cap = W.orderBy((F.col("cap") / F.col("weight")), F.col("place"))
    per = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("left", F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("share", F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("open", F.col("left") * F.col("weight") <= F.col("cap") * F.col("share"))
        .withColumn("rank", F.row_number().over(by_cap))
        .withColumn("first_open", F.min(F.when(F.col("open"), F.struct("rank", "left", "share"))).over(W.partitionBy()))
        .withColumn("capped", F.col("first_open").isNull() | (F.col("rank") < F.col("first_open.rank")))
        .withColumn("num", F.col("first_open.left") * F.col("weight"))
        .withColumn("den", F.col("first_open.share"))
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("num").cast("double") / F.col("den").cast("double"))
    repeats = F.when(F.col("source_size") == 0, F.lit(0)).when(F.col("capped"), F.lit(most)).otherwise(F.expr("num div (den * source_size)"))
    return (
        per.withColumn("target", target).withColumn("repeats", repeats.cast("long"))
        .withColumn("budget", F.col("target") - F.col("repeats") * F.col("source_size"))
        .select("source", "source_size", "target", "repeats", "budget")
    )


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """budgets: source, budget_id, budget (words). Returns source, budget_id, threshold: take hashes below it.

    The value at which a budget runs out is included if that comes nearer to the budget.
    """
    open_ = budgets.select("source", "budget_id", "budget", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("below"))
    rows, done = sizes, None
    for level, shift in enumerate(LEVELS):
        b = open_.select(F.col("source").alias("b_source"), "budget_id", "budget", F.col("at").alias("b_at"), "below")
        same = F.col("source").eqNullSafe(F.col("b_source"))
        if level:
            # Only the boundary buckets' rows are read from here on.
            rows = materialized(rows.join(open_.select(F.col("source").alias("b_source"), F.col("at").alias("b_at")).distinct(), same & (F.shiftright("h", LEVELS[level - 1]) == F.col("b_at")), "left_semi"), f"mix-rows{level}")
        hist = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        joined = hist.join(b, same & (F.shiftright("bucket", LEVELS[level - 1] - shift) == F.col("b_at")) if level else same)
        through = F.sum("words").over(W.partitionBy("source", "budget_id").orderBy("bucket")) + F.col("below")
        ends = joined.withColumn("through", through).where((F.col("through") > F.col("budget")) & (F.col("through") - F.col("words") <= F.col("budget")))
        open_ = ends.select("source", "budget_id", "budget", F.col("bucket").alias("at"), (F.col("through") - F.col("words")).alias("below"), "through")
        if shift == 0:
            done = open_.select("source", "budget_id", (F.col("at") + F.when(F.col("through") - F.col("budget") <= F.col("budget") - F.col("below"), 1).otherwise(0)).alias("threshold"))
        open_ = materialized(open_.drop("through"), f"mix-level{level}") if shift else open_
    return done


def planned(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """w_source, source_size, target, repeats, threshold: a row a source, by which any document of it is decided."""
    wanted = materialized(targets(sizes, weights, most), "mix-targets")
    ends = thresholds(sizes, wanted.select("source", F.lit(0).alias("budget_id"), "budget").where("budget > 0"))
    return materialized(
        wanted.join(ends.select(F.col("source").alias("e_source"), "threshold"), F.col("source").eqNullSafe(F.col("e_source")), "left")
        .select(F.col("source").alias("w_source"), "source_size", "target", "repeats", F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold")),
        "mix-plan",
    )


def times() -> Column:
    """How often a document of hash h is taken."""
    return F.col("repeats") + (F.col("h") < F.col("threshold")).cast("long")


def repeated(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The rows of `docs` that have a word, each as often as the mix takes it; nothing but the plan is joined to them."""
    plan = planned(materialized(sized(docs).select("source", "size", "h"), "mix-sizes"), weights, most)
    # Columns go by their places meanwhile, so no name of theirs can clash.
    names = [f"d{k}" for k in range(len(docs.columns))]
    doc_id, source, text = (names[docs.columns.index(c)] for c in ("doc_id", "source", "text"))
    rows = docs.toDF(*names).where(text_or_empty(text).rlike(WORD)).withColumns({"h": id_hash(doc_id), "m_source": F.col(source).cast("string")})
    taken = rows.join(plan, F.col("m_source").eqNullSafe(F.col("w_source"))).withColumn("times", times()).where("times > 0")
    return taken.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*(F.col(k).alias(c) for k, c in zip(names, docs.columns)))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of `docs`."""
    sizes = materialized(sized(docs), "mix-sizes")
    plan = planned(sizes, weights, most)
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("w_source"))).select("doc_id", "size", "source_size", "target", (F.col("size") * times()).alias("taken"))


#: The same by running sums over each source's hash values in order, in DuckDB SQL.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight, source_size * 3 AS cap FROM s),
o AS (SELECT *, row_number() OVER c AS rank,
         (SELECT sum(source_size) FROM s)::BIGINT - coalesce(sum(cap) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS remaining,
         sum(weight) OVER (c ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS share
      FROM w WINDOW c AS (ORDER BY cap / weight, place)),
f AS (SELECT rank AS first_open, remaining AS r, share AS sh FROM o WHERE remaining * weight <= cap * share ORDER BY rank LIMIT 1),
t AS (SELECT source, source_size,
         CASE WHEN f.first_open IS NULL OR rank < f.first_open THEN cap::DOUBLE ELSE (f.r * weight)::DOUBLE / f.sh::DOUBLE END AS target,
         CASE WHEN source_size = 0 THEN 0 WHEN f.first_open IS NULL OR rank < f.first_open THEN 3 ELSE (f.r * weight) // (f.sh * source_size) END::BIGINT AS repeats
      FROM o LEFT JOIN f ON true),
c AS (SELECT source, h, sum(words) OVER (PARTITION BY source ORDER BY h)::BIGINT AS through, words
      FROM (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY source, h)),
k AS (SELECT c.source AS k_source, c.h AS k_h
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      WHERE (c.through <= t.target - t.repeats * t.source_size) OR
            (c.through - c.words <= t.target - t.repeats * t.source_size AND
             c.through - (t.target - t.repeats * t.source_size) <= (t.target - t.repeats * t.source_size) - (c.through - c.words) AND
             t.target - t.repeats * t.source_size > 0))
SELECT d.doc_id, d.size, t.source_size, t.target,
       (d.size * (t.repeats + CASE WHEN k.k_h IS NULL OR t.target - t.repeats * t.source_size <= 0 THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.k_source AND d.h = k.k_h
"""
