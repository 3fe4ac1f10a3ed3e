"""Chains of network edges.

Edges: feature keys, edge_id, from_node, to_node and an ordinal that fixes their order. A group is the
edges of one road feature; `sorted_chains` walks each group on its own, many groups a task. Edges that
could begin a chain and parallel edges are found by joins and windows, as is whether a group forms chains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import VERTEX_KEY_DECIMALS
from ..functions import geodesy as geo
from ..functions.scalars import is_something
from ..lineage import checkpointed

# Names of errors.
NO_SOURCE, MANY_SOURCES_1, MANY_SOURCES_2 = "ERR_NO_SOURCE_NODES", "ERR_NUM_SOURCE_NODES_EXCEEDS_1", "ERR_NUM_SOURCE_NODES_EXCEEDS_2"
MANY_CHAINS_1, MANY_CHAINS_2 = "ERR_NUM_CHAINS_EXCEEDS_1", "ERR_NUM_CHAINS_EXCEEDS_2"

#: From chains of this length on, the largest group is counted, which tells long chains from rings.
RING_CHECK = 256


def with_edge_nodes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sets from_node and to_node: the given ones if all edges of a group have one of them, else keys of the rounded end points."""
    group = W.partitionBy(*keys)
    given = F.min((is_something(F.col("from_node")) | is_something(F.col("to_node"))).cast("int")).over(group) == 1
    df = df.withColumn("__given", F.coalesce(given, F.lit(False)))
    key = lambda p: geo.node_key(p, VERTEX_KEY_DECIMALS)
    pick = lambda c, p: F.when(F.col("__given"), F.col(c)).otherwise(key(p))
    return df.withColumns({"from_node": pick("from_node", geo.first(F.col("geometry"))), "to_node": pick("to_node", geo.last(F.col("geometry")))}).drop("__given")


def without_parallels(edges: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Of edges with the same ends the one with most vertices, the last of equal ones."""
    w = W.partitionBy(*keys, "from_node", "to_node").orderBy(size.desc(), F.col("ordinal").desc())
    return edges.withColumn("__nth", F.row_number().over(w)).where("__nth = 1").drop("__nth")


def source_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Edges into which no other edge of their group flows; an edge's opposite doesn't count."""
    other = edges.select(*(F.col(k).alias(f"o_{k}") for k in keys), F.col("edge_id").alias("o_id"), F.col("from_node").alias("o_from"), F.col("to_node").alias("o_to"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"o_{k}"))
    flows_in = (F.col("o_to") == F.col("from_node")) & (F.col("o_id") != F.col("edge_id")) & ~F.coalesce((F.col("o_from") == F.col("to_node")), F.lit(False))
    return edges.join(other, on & flows_in, "left_anti")


def source_status(edges: DataFrame, keys: list[str], most: int) -> DataFrame:
    """keys, n_sources, error: null where a group has between one and `most` sources."""
    counts = source_edges(edges, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sources"))
    n = F.coalesce(F.col("n_sources"), F.lit(0))
    error = F.when(n == 0, NO_SOURCE).when(n > most, MANY_SOURCES_1 if most == 1 else MANY_SOURCES_2)
    return edges.select(*keys).distinct().join(counts, keys, "left").select(*keys, n.alias("n_sources"), error.alias("error"))


def forms_chains(edges: DataFrame, keys: list[str], most: int = 2) -> DataFrame:
    """keys, ok: a single edge is a chain, more need between one and `most` sources."""
    counts = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_edges"))
    joined = counts.join(source_status(edges, keys, most), keys)
    return joined.select(*keys, ((F.col("n_edges") == 1) | F.col("error").isNull()).alias("ok"))


@dataclass(frozen=True)
class Edge:
    id: object
    a: object
    b: object

    def opposes(self, other: Edge) -> bool:
        return self.a == other.b and self.b == other.a

    def leads_to(self, other: Edge) -> bool:
        return self.b == other.a and self.id != other.id


def starts_of(edges: list[Edge]) -> list[Edge]:
    """Edges into which no other one leads; an edge's opposite doesn't count."""
    into: dict[object, list[Edge]] = {}
    for e in edges:
        into.setdefault(e.b, []).append(e)
    return [e for e in edges if not any(o.id != e.id and not o.opposes(e) for o in into.get(e.a, ()))]


def grow(edges: list[Edge], starts: list[Edge], most: int | None = None) -> list[list[Edge]]:
    """Chains from each start, in the order they come up: of several ways on the last is followed, the others fork off.

    Ends early with more than `most` chains, which forks only make more.
    """
    out: dict[object, list[Edge]] = {}
    for e in edges:
        out.setdefault(e.a, []).append(e)
    chains, done = [[s] for s in starts], 0
    while done < len(chains) and (most is None or len(chains) <= most):
        chain = chains[done]
        ids, ends = {c.id for c in chain}, {(c.b, c.a) for c in chain}
        while on := [e for e in out.get(chain[-1].b, ()) if e.id not in ids and (e.a, e.b) not in ends]:
            chains += [[*chain, e] for e in on[:-1]]
            chain.append(on[-1])
            ids.add(on[-1].id)
            ends.add((on[-1].b, on[-1].a))
            if most is not None and len(chains) > most:
                break
        done += 1
    return chains


def within_chain(short: list[Edge], long: list[Edge]) -> bool:
    """Do the steps of `short` come up in `long` in order?"""
    rest = iter(long)
    return all(any((e.a, e.b) == (o.a, o.b) for o in rest) for e in short)


def sort_edges(edges: list[Edge], both_ways: bool) -> tuple[list[list[Edge]], str | None]:
    """Chains and no error, or no chains and an error. One-way features make one chain, two-way ones up to two."""
    starts = starts_of(edges)
    most = 2 if both_ways else 1
    if not starts:
        return [], NO_SOURCE
    if len(starts) > most:
        return [], MANY_SOURCES_2 if both_ways else MANY_SOURCES_1
    chains = grow(edges, starts, most)
    if len(chains) > most:
        return [], MANY_CHAINS_2 if both_ways else MANY_CHAINS_1
    chains.sort(key=len)
    return [c for i, c in enumerate(chains) if not any(within_chain(c, o) for o in chains[i + 1 :])], None


def reference_chains(edges: list[Edge]) -> tuple[list[list[Edge]], str | None]:
    """All chains, those within others too; a single edge is one as it is."""
    if len(edges) == 1:
        return [edges], None
    starts = starts_of(edges)
    if not starts:
        return [], NO_SOURCE
    return ([], MANY_SOURCES_2) if len(starts) > 2 else (grow(edges, starts), None)


def sorted_chains(edges: DataFrame, keys: list[str], both_ways: bool, all_chains: bool = False) -> DataFrame:
    """keys, chain, idx, edge_id, chain_length, error: a row for each place in a chain, or one with the error."""
    kinds = ", ".join(f"{k} {edges.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, chain int, idx int, edge_id string, chain_length int, error string"

    width = len(keys)

    def solved(group: list[tuple]) -> list[tuple]:
        own = [Edge(*x[width:]) for x in group]
        found, error = reference_chains(own) if all_chains else sort_edges(own, both_ways)
        head = group[0][:width]
        return [(*head, c, i, e.id, len(chain), None) for c, chain in enumerate(found) for i, e in enumerate(chain)] or [(*head, None, None, None, None, error)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, out, kinds_of = [], [], None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds_of)], names=[*keys, "chain", "idx", "edge_id", "chain_length", "error"])

        for batch in batches:
            kinds_of = [*(batch.schema.field(k).type for k in range(width)), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string()]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:width] != group[0][:width]:
                    out += solved(group)
                    group = []
                    if len(out) >= 10_000:
                        yield batch_of(out)
                        out = []
                group.append(row)
        if group:
            out += solved(group)
        if out:
            yield batch_of(out)

    dealt = edges.select(*keys, F.col("edge_id").cast("string"), "from_node", "to_node", "ordinal").repartition(*keys)
    return dealt.sortWithinPartitions(*keys, F.col("ordinal").asc_nulls_last()).drop("ordinal").mapInArrow(run, schema)


def simple_chains(edges: DataFrame) -> DataFrame:
    """grp, edge_id, idx: places in chains without forks, by joins over (grp, edge_id, from_node, to_node).

    Each edge looks for where its chain starts: what is known of the edge it has reached takes it as far again,
    so a chain takes as many rounds as its length has binary digits. Of edges with several ways behind them there
    is a row for each; rings that no start leads to give none.
    """
    e = edges.select("grp", "edge_id", "from_node", "to_node")
    o = e.select(F.col("grp").alias("o_grp"), F.col("edge_id").alias("before"), F.col("to_node").alias("o_to"))
    behind = (F.col("o_grp") == F.col("grp")) & (F.col("o_to") == F.col("from_node")) & (F.col("before") != F.col("edge_id"))
    made = checkpointed(e.join(o, behind, "left").select("grp", "edge_id", "before", F.when(F.col("before").isNull(), 0).otherwise(1).alias("idx")))
    done, live = made.where("before is null"), made.where("before is not null")
    reach, most = 1, None
    while not live.isEmpty():
        if most is None and reach > RING_CHECK:
            most = made.groupBy("grp").count().agg(F.max("count")).first()[0]
        if most is not None and reach > 2 * most:
            if not done.where(F.col("idx") >= most).isEmpty():
                raise ValueError("a start leads into a ring of edges, so its chain has no end")
            break
        far = done.unionByName(live).select(F.col("grp").alias("o_grp"), F.col("edge_id").alias("at"), F.col("before").alias("farther"), F.col("idx").alias("more"))
        on = (F.col("o_grp") == F.col("grp")) & (F.col("at") == F.col("before"))
        step = checkpointed(live.join(far, on).select("grp", "edge_id", F.col("farther").alias("before"), (F.col("idx") + F.col("more")).alias("idx")))
        done, live = done.unionByName(step.where("before is null")), step.where("before is not null")
        reach *= 2
    return done.select("grp", "edge_id", "idx")
