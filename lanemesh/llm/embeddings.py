"""Near-duplicate vectors by random hyperplanes in several tables, with exact verification.

Vectors of one label that fall on the same side of `bits` random hyperplanes meet in a bucket of a
table. Tables are as many as make a pair at the threshold be missed with probability `miss` at most.
Within buckets all cosines are computed in double precision, block by block; a pair that met in an
earlier table is not counted again. Buckets above `block` vectors are split into blocks, and every
pair of blocks is a task of its own, so nothing is capped. Equal vectors are collapsed first. No
pairs leave a task: only numbers of links and, for the components, one edge a vector.

Defined cases: null labels, null, empty or zero vectors and vectors with null or non-finite
components link with nothing and are kept; vectors of different lengths don't link; rows that repeat
a vec_id with the same vector are one vector and come out alike; a null vec_id links with nothing,
has a null component and is not kept; of equal vectors and of linked ones the smallest vec_id names the
component, so ties can't occur; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, materialized, spread_join
from .graph import components

SEED = 20240229
#: Bytes that a verifying task reads, about.
SHARE = 32 << 20


def plan_tables(largest: int, threshold: float, miss: float, least_bits: int = 6) -> tuple[int, int]:
    """bits, tables for labels of up to `largest` vectors. Without bits all vectors of a label share a bucket."""
    if not miss:
        return 0, 1
    same = 1 - math.acos(threshold) / math.pi
    bits = min(24, max(least_bits, math.ceil(math.log2(max(largest, 2) / 24))))
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-(same**bits))))


def signatures(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) uint32: the side of each hyperplane, a table at a time."""
    planes = np.random.default_rng([SEED, x.shape[1]]).standard_normal((x.shape[1], tables * bits))
    sides = (x @ planes > 0).reshape(len(x), tables, bits)
    return (sides << np.arange(bits, dtype=np.uint32)).sum(2, dtype=np.uint32)


def link_block(x: np.ndarray, rep: np.ndarray, mult: np.ndarray, sig: np.ndarray, at: int, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links new in table `at` (weighted by multiplicity), and the least rep of each vector's component.

    side: None for all pairs of the block, else only pairs of different sides.
    """
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if side is not None:
        near &= side[:, None] != side[None, :]
    new = near
    if at and near.any():
        i, j = np.nonzero(near)
        new = near.copy()
        again = np.zeros(len(i), bool)
        for t in range(at):
            again |= sig[i, t] == sig[j, t]
        new[i[again], j[again]] = False
    links = new @ mult
    least = rep.copy()
    if new.any():
        rows = np.flatnonzero(near.any(1))
        part = near[np.ix_(rows, rows)]
        while True:
            reach = np.where(part, least[rows][None, :], np.iinfo(np.int64).max).min(1)
            step = np.minimum(least[rows], reach)
            if (step == least[rows]).all():
                break
            least[rows] = step
    return links, least


def linked(vectors: DataFrame, threshold: float = 0.98, miss: float = 1e-4, block: int = 2048, least_bits: int = 6) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding, label).

    With miss=0 no link is lost: a label's vectors are then all compared, block by block.
    """
    spark = vectors.sparkSession
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() == "double"
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'double' if wide else 'float'}>").alias("embedding"), F.col("label").cast("string").alias("label"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    good = raw.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))

    classes = materialized(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("mult"), F.count(F.lit(1)).alias("copies")), "vec-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, miss, least_bits)
    kind = np.float64 if wide else np.float32

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for n, same in pdf.groupby(pdf["embedding"].map(len)):
                x = np.stack(same["embedding"].to_numpy()).astype(kind)
                # A common scale keeps double precision from over- or underflowing in norms.
                sig = signatures(np.asarray(x, np.float64) / np.abs(x).max(1, keepdims=True), bits, tables)
                yield pd.DataFrame({"label": same["label"].to_numpy(), "dim": n, "rep": same["rep"].to_numpy(), "mult": same["mult"].to_numpy(), "x": [v.tobytes() for v in x], "sig": [s.tobytes() for s in sig]})

    signed = materialized(classes.mapInPandas(sign, "label string, dim int, rep long, mult long, x binary, sig binary"), "vec-signed")
    own = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(t.alias("t"), F.substring(F.col("sig"), t * 4 + 1, F.lit(4)).alias("s")))
    rows = signed.select("label", "dim", "rep", "mult", "x", "sig", F.inline(own)).withColumn("bucket", F.xxhash64("label", "dim", "t", "s"))
    full = materialized(rows.groupBy("bucket").count().where("count > 1").withColumn("g", F.ceil(F.col("count") / block).cast("int")).select(F.col("bucket").alias("b"), "g"), "vec-buckets")
    r = F.pmod(F.xxhash64("rep"), F.col("g")).cast("int")
    dealt = (
        rows.join(full, F.col("bucket") == F.col("b")).withColumn("r", r)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        .select("label", "dim", "t", "s", "bucket", F.least("r", "j").alias("bi"), F.greatest("r", "j").alias("bj"), "r", "rep", "mult", "x", "sig")
    )
    keys = ["bucket", "label", "dim", "t", "s", "bi", "bj"]

    def verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
            cut = np.flatnonzero(np.r_[True, np.logical_or.reduce([pdf[k].to_numpy()[1:] != pdf[k].to_numpy()[:-1] for k in keys]), True])
            out = []
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a < 2:
                    continue
                g = pdf.iloc[a:b]
                x = np.frombuffer(b"".join(g["x"]), kind).reshape(b - a, -1).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                sig = np.frombuffer(b"".join(g["sig"]), np.uint32).reshape(b - a, -1)
                rep, side = g["rep"].to_numpy(), g["r"].to_numpy()
                links, least = link_block(x, rep, g["mult"].to_numpy(), sig, int(g["t"].iloc[0]), side if g["bi"].iloc[0] != g["bj"].iloc[0] else None, threshold)
                hit = (links > 0) | (least != rep)
                if hit.any():
                    out.append(pd.DataFrame({"rep": rep[hit], "links": links[hit], "least": least[hit]}))
            if out:
                yield pd.concat(out)

        held = None
        for pdf in parts:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = pdf[keys].ne(pdf[keys].iloc[-1]).any(axis=1).to_numpy().nonzero()[0]
            begin = last[-1] + 1 if len(last) else 0
            held = pdf.iloc[begin:]
            if begin:
                yield from solve(pdf.iloc[:begin])
        if held is not None:
            yield from solve(held)

    # A vector goes to a task once a table, with its signatures.
    dims = classes.agg(F.sum(F.size("embedding"))).first()[0] or 0
    held = tables * (dims * np.dtype(kind).itemsize + classes.count() * (4 * tables + 100))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(held / SHARE))
    found = materialized(dealt.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(verify, "rep long, links long, least long"), "vec-found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = components(found.where("least <> rep").select(F.col("rep").alias("a"), F.col("least").alias("b")), "vec-components")
    result = materialized(
        classes.select("rep", "mult").join(links, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("rep").alias("c_rep"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")),
        "vec-result",
    )
    dropped(signed, full, found)
    # Members of classes of several vectors find their class by value; all others are their own.
    shared = classes.where("mult > 1").select(F.col("label").alias("c_label"), F.col("embedding").alias("c_embedding"), F.col("rep").alias("shared_rep"), "copies")
    members = spread_join(raw, shared, {"label": "c_label", "embedding": "c_embedding"}, "shared_rep", "copies", vectors.count(), F.col("vec_id")).select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("shared_rep", "vec_id")).alias("rep"))
    return members.join(result, F.col("rep") == F.col("c_rep"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: All pairs of a label by exact cosine, in DuckDB SQL.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_dot_product(a.e, b.e) >= 0.98 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN c ON c.node = m.vec_id LEFT JOIN n ON n.a = m.vec_id
"""
