"""Groups of features: first of duplicates, overlays, modes, folds, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geodesy as geo


def first_of(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row a key, the first in a given order: inserts that ignore later duplicates."""
    return df.withColumn("__nth", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__nth = 1").drop("__nth")


def collected(df: DataFrame, keys: list[str], columns: list[str], name: str = "features") -> DataFrame:
    """Members of each group without null keys as an ordered array of structs."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def overlay_last(df: DataFrame, keys: list[str], order: str, columns: list[str], blank_counts: bool = True) -> DataFrame:
    """One row a key; each column's last value that isn't null (nor blank, unless that counts)."""
    value = lambda c: F.col(c) if blank_counts else F.when(F.col(c).cast("string") != "", F.col(c))
    return df.groupBy(*keys).agg(*(F.max_by(value(c), F.when(value(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def longest(df: DataFrame, keys: list[str], order: str, size: Column, columns: list[str]) -> DataFrame:
    """One row a key, of most vertices; the first of equal ones."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(size.alias("n"), (-F.col(order)).alias("o"))).alias("v")).select(*keys, *(f"v.{c}" for c in columns))


def modal(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """The most frequent value of each group, the larger of equally frequent ones."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.max_by(column, F.struct("n", column)).alias(name))


def selected_candidates(candidates: DataFrame, key: str, order: str) -> DataFrame:
    """Per key a fold over candidates in order: one replaces the choice if that is reversed and it is not, or if it has more vertices.

    candidates: key, order, reversed, n_vertices and a struct `candidate`.
    """
    rows = candidates.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "reversed", "n_vertices", "candidate"))).alias("c"))
    better = lambda acc, x: (acc["reversed"] & ~x["reversed"]) | (x["n_vertices"] > acc["n_vertices"])
    pick = F.aggregate(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), F.col("c")[0], lambda acc, x: F.when(better(acc, x), x).otherwise(acc))
    return rows.select(key, pick.alias("p")).select(key, "p.candidate.*")


def meso_indexed(df: DataFrame, meso: str, direction: str, order: Column, needs: list[str], most_directions: int = 2) -> DataFrame:
    """Adds meso_idx and meso_bearing to groups whose members all have `needs` and that go in two directions at most; else null.

    A direction's bearing is from its first member's first point to its last member's last point.
    """
    group, line = W.partitionBy(meso), W.partitionBy(meso, direction)
    have = F.lit(True)
    for c in needs:
        have = have & F.col(c).isNotNull()
    usable = F.col(meso).isNotNull() & (F.min(have.cast("int")).over(group) == 1) & (F.size(F.collect_set(direction).over(group)) <= most_directions)
    by = line.orderBy(order, "target_map_id")
    whole = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bearing = F.round(geo.final_bearing(F.first(geo.first(F.col("geometry"))).over(whole), F.last(geo.last(F.col("geometry"))).over(whole))).cast("int")
    df = df.withColumn("__use", F.coalesce(usable, F.lit(False))).withColumn("__idx", F.row_number().over(by) - 1).withColumn("__bearing", bearing)
    return df.withColumn("meso_idx", F.when(F.col("__use"), F.col("__idx"))).withColumn("meso_bearing", F.when(F.col("__use"), F.col("__bearing"))).drop("__use", "__idx", "__bearing")


def inverted(df: DataFrame, owner: str, item: str, position: str) -> DataFrame:
    """item, owners: a map from each owner to the sorted positions at which it holds the item."""
    per = df.groupBy(item, owner).agg(F.sort_array(F.collect_list(position)).alias("positions"))
    return per.groupBy(item).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(owner, "positions")))).alias("owners"))


def patched(base: DataFrame, patch: DataFrame, key: str, stated: str | None = None) -> DataFrame:
    """A merge patch by key: what a patch states wins, a null that it states deletes, unknown keys are left out.

    stated: a column of `patch` with the names of the columns that it states; without one, all of them.
    """
    names = [c for c in patch.columns if c not in (key, stated)]
    p = patch.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in names), (F.col(stated) if stated else F.array(*map(F.lit, names))).alias("__stated"))
    joined = base.join(p, F.col(key) == F.col("__key"), "left")
    value = lambda c: F.when(F.array_contains("__stated", c), F.col(f"__{c}")).otherwise(F.col(c)) if c in names else F.col(c)
    return joined.select(*(value(c).alias(c) for c in base.columns), *(F.col(f"__{c}").alias(c) for c in names if c not in base.columns))


def unmatched(targets: DataFrame, matches: DataFrame, key: str = "target_map_id") -> DataFrame:
    """Rows of `targets` that nothing matches."""
    return targets.join(matches.select(key).distinct(), key, "left_anti")


def still_to_do(targets: DataFrame, *done: DataFrame, key: str = "target_map_id") -> DataFrame:
    """Resuming: rows that none of several tables of results has yet."""
    ids = done[0].select(key)
    for d in done[1:]:
        ids = ids.unionByName(d.select(key))
    return targets.join(ids.distinct(), key, "left_anti")
