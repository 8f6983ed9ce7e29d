"""Helpers shared by the operators: tables in the shared folder, ranks, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webevents.session import ensure_checkpoint_dir

# The white space of every contract here, as a regular-expression class
# and as the characters themselves (space, tab, line feed, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


#: Entries in one generation of a worker's memory (about 200 bytes each for ids of words).
MEMORY = 200_000


class Memory(dict):
    """Values of keys met lately, for a function of one key.

    When a generation is full it becomes the old one, and the one before it is forgotten."""

    def __init__(self, compute: Callable, size: int | None = None):
        super().__init__()
        self.compute, self.size, self.old = compute, size or MEMORY, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def turn(self) -> None:
        """Begin a generation if this one is full."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()

    def all(self, keys: list) -> Iterable:
        """The value of every key, in order."""
        self.turn()
        return map(self.__getitem__, keys)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def addressed(df: DataFrame, label: str, file: str, row: str) -> DataFrame:
    """``df`` stored, with the columns ``file`` and ``row``: where each row lies, so that equal rows differ too."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    where = held.metadataColumn("_metadata")
    return held.select("*", F.xxhash64(where["file_name"]).alias(file), where["row_index"].alias(row))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from Python or NumPy columns, cast to ``schema``."""
    arrays = [
        c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
        for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def global_rank(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Add ``name``: the row's 0-based rank in ``order`` over the whole table.

    Range partitions are ranked one by one and shifted by the sizes of the partitions
    before them, so no task sees more than one range. The sizes are one row per range
    (at most ``spark.sql.shuffle.partitions``), small enough to broadcast.
    """
    ranged = stored(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label
    )
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (
        ranged.withColumn("_local", local)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_range", "_local", "_start")
    )


def spread(df: DataFrame, key: str, most: int = 10_000) -> DataFrame:
    """Small rows that stand for much work (files to read), one partition each up to ``most``.

    A stated number of partitions is one that adaptive execution doesn't merge by size."""
    return df.repartition(max(1, min(df.count(), most)), key)


def hash_share(rows: int, keep: int, *columns: Column | str, seed: int = 0) -> Column:
    """Filter that keeps about ``keep`` of ``rows`` rows, chosen by a hash of ``columns``.

    The choice depends on the values only, so reruns and retried tasks agree.
    """
    if rows <= keep:
        return F.lit(True)
    cut = int(keep / rows * 2**63)
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit(2**63 - 1)) < F.lit(cut)
