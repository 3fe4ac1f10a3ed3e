"""Numbers: positions within groups by windows, and positions over a whole table without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..lineage import checkpointed


def index_within(df: DataFrame, keys: list[str], order: list[str | Column], name: str, start: int = 0) -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)) + (start - 1))


def number_globally(df: DataFrame, order: list[str | Column], name: str, start: int = 1, after: DataFrame | None = None) -> DataFrame:
    """Consecutive numbers from `start` in the given order, which should be total.

    A range sort numbers the rows of each partition; partitions go on from the rows before them, of
    which one count a partition is summed up. The sorted table is checkpointed, so both passes see
    the same ranges. `after`: a table of one number that the numbers come after (a sequence's seed).
    """
    placed = checkpointed(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    bases = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__base"))
    out = placed.withColumn("__part", part).join(bases, "__part").withColumn(name, (F.col("__base") + F.col("__at").bitwiseAND((1 << 33) - 1) + start).cast("long"))
    out = out.drop("__part", "__at", "__base")
    if after is not None:
        seed = after.toDF("__seed").agg(F.max("__seed").alias("__seed"))
        out = out.join(seed, F.lit(True)).withColumn(name, (F.col(name) + F.coalesce("__seed", F.lit(0))).cast("long")).drop("__seed")
    return out.select(*[c for c in df.columns if c != name], name)
