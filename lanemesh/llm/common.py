"""What the operators of this subpackage share: reading tables, cutting lineage, word patterns, joins with hot keys."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import reduce, wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as all operators here count them: a run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A key with more than one in so many rows is hot. There are fewer such keys than this, whatever the input.
HOT_SHARE = 1000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only one machine alone may do without a named one."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return "file:///tmp/checkpoints/lanemesh"


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def removed_at_exit(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.deleteOnExit(at)


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and gives later joins real sizes. The
    table goes when `dropped` is called or the driver ends. The driver gives back what planning and
    running it took beside its heap.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    driver_gives_back(df.sparkSession)
    removed_at_exit(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete what `materialized` wrote; nothing that is still to be computed may read it."""
    for df in frames:
        at, files = _file_system(df.sparkSession, df.scratch)
        files.delete(at, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python get at most so many texts at a time, in this session: Spark's 10,000 are 40 MB and more, several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def give_back() -> None:
    """Return this process's freed memory to the system; with another C library only what Arrow holds."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def driver_gives_back(spark: SparkSession) -> None:
    """Return native memory that the driver's JVM has freed to the system; nothing happens where the JVM has no such command.

    The C library keeps what the JVM's threads have freed in many heaps of its own. In the pipeline these
    held about 0.5 GB without this, more than the JVM's heap, and go on growing with the plans that are run.
    """
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    lang, bean = jvm.java.lang, jvm.javax.management
    try:
        # By the interface, as the class of the server is closed to reflection.
        (invoke,) = (m for m in lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = array(lang.Object, 4)
        given[0], given[1] = bean.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        given[2], given[3] = array(lang.Object, 0), array(lang.String, 0)
        invoke.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        pass


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`function` for mapInArrow or mapInPandas, after which its worker, which goes on to wait for other tasks, keeps no memory that is free."""

    @wraps(function)
    def run(parts: Iterator) -> Iterator:
        try:
            yield from function(parts)
        finally:
            give_back()

    return run


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def spread_join(big: DataFrame, small: DataFrame, on: dict[str, str], value: str, copies: str, rows: int, spread: Column) -> DataFrame:
    """`big` with `value` of the row of `small` that has its key, null without one.

    small: a row a key, and in `copies` how many rows of `big` have it. `rows`: how many `big` has,
    about. Only hot keys, fewer than HOT_SHARE whatever the input, are salted: `spread` deals their rows
    to as many parts as there are shuffle partitions, and their rows of `small` go to all of these.
    """
    mine, theirs = ([F.col(c) for c in side] for side in (on.keys(), on.values()))
    hot = [r[0] for r in small.where(F.col(copies) * HOT_SHARE > F.lit(rows)).select(F.xxhash64(*theirs)).collect()]
    own = small.select(*(F.col(s).alias(f"own__{s}") for s in on.values()), F.col(value).alias("own__value"), F.xxhash64(*theirs).alias("own__hash"))
    match = reduce(Column.__and__, (F.col(b) == F.col(f"own__{s}") for b, s in on.items()))
    out = big
    if hot:
        parts = max(2, int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        own = own.withColumn("own__salt", F.explode(F.when(F.col("own__hash").isin(hot), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))))
        out = big.withColumn("big__salt", F.when(F.xxhash64(*mine).isin(hot), F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int")).otherwise(0))
        match = match & (F.col("big__salt") == F.col("own__salt"))
    return out.join(own, match, "left").select(*(F.col(f"`{c}`") for c in big.columns), F.col("own__value").alias(value))


def grouped(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a stream that is sorted by `keys`, a frame a group; holds one group and one batch."""
    held: list[pd.DataFrame] = []

    def cuts(pdf: pd.DataFrame) -> np.ndarray:
        return np.flatnonzero(np.logical_or.reduce([pdf[k].to_numpy()[1:] != pdf[k].to_numpy()[:-1] for k in keys])) + 1

    for pdf in parts:
        if not len(pdf):
            continue
        held.append(pdf)
        if len(held) > 1 and all(held[0][k].iloc[-1] == pdf[k].iloc[-1] for k in keys):
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
        at = [0, *cuts(whole)]
        for a, b in zip(at[:-1], at[1:]):
            yield whole.iloc[a:b]
        held = [whole.iloc[at[-1] :]]
    if held:
        whole = pd.concat(held, ignore_index=True)
        at = [0, *cuts(whole), len(whole)]
        for a, b in zip(at[:-1], at[1:]):
            yield whole.iloc[a:b]
