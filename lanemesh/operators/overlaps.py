"""Removing overlaps among the intervals of one target map along one reference.

`resolve` folds the intervals of a group in order of priority, as a sequence of decisions has to be, many groups a task.
`resolve_elementary` says the same for threshold 0 as a plan: cut at all ends, give every piece to its
first claimant, and merge neighbouring pieces of one owner.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import SPLIT_BUFFER_KM


def classify(low_start: Column, low_end: Column, high_start: Column, high_end: Column) -> Column:
    """How an interval of lower priority lies to one of higher priority."""
    return (
        F.when((low_start >= high_end) | (low_end <= high_start), "NO_OVERLAP")
        .when((low_start >= high_start) & (low_end <= high_end), "COVERED")
        .when(low_start >= high_start, "TRAILING")
        .when(low_end <= high_end, "LEADING")
        .otherwise("COVERS")
    )


def cut_one(start: float, end: float, accepted: list[tuple[float, float]], threshold: float) -> tuple[float, float, list[tuple[float, float]]]:
    """What is left of an interval in front of the accepted ones, and the pieces cut off behind them."""
    behind = []
    for a, b in accepted:
        if end <= start or end - start < threshold:
            return 0.0, 0.0, behind
        if start >= b or end <= a:
            continue
        if start >= a:
            start = b if end > b else end
        else:
            if end > b and end - b > SPLIT_BUFFER_KM / 2:
                behind.append((b, end))
            end = a
    return start, end, behind


def fold(intervals: list[tuple[float, float]], threshold: float) -> list[tuple[int, float, float]]:
    """(index of the interval, start, end) of all that is accepted, in order of start.

    The first interval is accepted as it is. Pieces cut off come up next, the last one first.
    """
    accepted: list[tuple[float, float]] = []
    out = []
    stack = [(i, a, b) for i, (a, b) in reversed(list(enumerate(intervals)))]
    while stack:
        i, a, b = stack.pop()
        if accepted or out:
            a, b, behind = cut_one(a, b, accepted, threshold)
            stack += [(i, x, y) for x, y in behind]
            if not (b > a and b - a >= threshold):
                continue
        accepted.append((a, b))
        out.append((i, a, b))
    return sorted(out, key=lambda x: x[1])


def resolve(intervals: DataFrame, order: list[str], threshold: float = SPLIT_BUFFER_KM) -> DataFrame:
    """`intervals` (reference_id, target_map, start_dist, end_dist, ...) with overlaps removed.

    order: columns whose values give priority, made total by a key. A group is what lies along one
    road piece, so it is small whatever the input.
    """
    schema = intervals.schema

    def folded(rows: pa.Table) -> list[pa.RecordBatch]:
        firsts = np.flatnonzero(rows.column("__nth").to_numpy() == 1).tolist()
        spans = list(zip(rows.column("start_dist").to_pylist(), rows.column("end_dist").to_pylist()))
        index, starts, ends = [], [], []
        for first, behind in zip(firsts, [*firsts[1:], len(spans)]):
            for i, a, b in fold(spans[first:behind], threshold) if behind - first > 1 else [(0, *spans[first])]:
                index.append(first + i)
                starts.append(a)
                ends.append(b)
        out = rows.drop_columns(["__nth"]).take(pa.array(index, pa.int64()))
        for c, values in (("start_dist", starts), ("end_dist", ends)):
            at = out.schema.get_field_index(c)
            out = out.set_column(at, out.schema.field(at), pa.array(values, out.schema.field(at).type))
        return out.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            firsts = np.flatnonzero(batch.column("__nth").to_numpy() == 1)
            if held and len(firsts):
                yield from folded(pa.Table.from_batches([*held, batch.slice(0, firsts[-1])]))
                held = []
            elif len(firsts) and firsts[-1]:
                yield from folded(pa.Table.from_batches([batch.slice(0, firsts[-1])]))
            held.append(batch.slice(firsts[-1]) if len(firsts) else batch)
        if held:
            yield from folded(pa.Table.from_batches(held))

    # The window deals out and sorts the rows, so that groups come up whole, in order of priority, many a task.
    line = W.partitionBy("reference_id", "target_map").orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return intervals.where("start_dist < end_dist").withColumn("__nth", F.row_number().over(line)).mapInArrow(run, schema)


def resolve_elementary(intervals: DataFrame, key: str, order: list[str]) -> DataFrame:
    """reference_id, target_map, key, start_dist, end_dist: who owns which stretch, threshold 0."""
    group = ["reference_id", "target_map"]
    good = intervals.where("start_dist < end_dist")
    ends = good.select(*group, F.explode(F.array("start_dist", "end_dist")).alias("at")).distinct()
    pieces = ends.withColumn("to", F.lead("at").over(W.partitionBy(*group).orderBy("at"))).where("to is not null")
    owner = F.min_by(F.col(key), F.struct(*order)).alias(key)
    owned = pieces.join(good, group).where("start_dist <= at and end_dist > at").groupBy(*group, "at", "to").agg(owner)
    line = W.partitionBy(*group).orderBy("at")
    new = ~((F.lag("to").over(line).eqNullSafe(F.col("at"))) & F.lag(key).over(line).eqNullSafe(F.col(key)))
    runs = owned.withColumn("run", F.sum(new.cast("int")).over(line))
    return runs.groupBy(*group, key, "run").agg(F.min("at").alias("start_dist"), F.max("to").alias("end_dist")).drop("run")
