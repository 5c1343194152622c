"""What the corpus operators share: the shared folder, lineage cuts, components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it was counted and has at most so many rows.
BROADCAST_ROWS = 50_000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        found = getattr(spark.sparkContext, "_tessera_shared", None)
        if not found:
            found = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
            spark.sparkContext._tessera_shared = found
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it: lineage ends there, a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table that :func:`cut` wrote and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows``, its counted size, is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def quoted(name: str) -> str:
    """A column name in back quotes: names may hold dots, spaces and back quotes."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(quoted(name))


def private(name: str) -> str:
    """A column name that tables from outside won't have."""
    return f"__tessera_{name}"


def lower_ascii(col):
    """A-Z to lower case, every other character as it is; null is empty.

    ``lower`` is the fast path where each code point is one byte.
    """
    text = F.coalesce(col, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def union_pairs(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the classes of ``i`` and ``j`` in ``labels`` (each label: the smallest index of its class)."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component: its smallest node.

    Every node points to its smallest neighbour, pointers are doubled until they
    rest on roots, edges between roots go to the next round. Sizes at least
    halve each round or so; each step is an aggregate or equi-join, written to
    the shared folder.
    """
    spark = edges.sparkSession
    edges = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    levels = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        pointer = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("to")), "pointer")
        while True:
            before = pointer
            upper = pointer.select(F.col("node").alias("to"), F.col("to").alias("top"))
            moved = cut(pointer.join(upper, "to").select("node", F.col("top").alias("to"), (F.col("top") != F.col("to")).alias("moved")), "pointer")
            pointer = moved.select("node", "to")
            drop(before)
            if moved.where("moved").isEmpty():
                break
        levels.append(pointer)
        a, b = (pointer.select(F.col("node").alias(x), F.col("to").alias(f"{x}2")) for x in "ab")
        before = edges
        edges = cut(edges.join(a, "a").join(b, "b").where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        drop(before)
    if not levels:
        return spark.createDataFrame([], "node long, component long")
    found = levels[-1].withColumnRenamed("to", "component")
    for level in reversed(levels[:-1]):
        roots = found.withColumnRenamed("node", "to")
        found = level.join(roots, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    return found


def rows_of(batches: Iterator, chars: int = 4_000_000) -> Iterator:
    """Record batches cut into slices of about ``chars`` bytes, so that Python objects stay few."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, min(n, int(n * chars / max(1, batch.nbytes)))) if n else 1
        for at in range(0, n, step):
            yield batch.slice(at, step)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which its worker gives back memory that it no longer uses: workers stay for later stages."""

    def through(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return through
