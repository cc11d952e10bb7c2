"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.parquet.columnarReaderBatchSize": "256"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the one the cluster names in spark.checkpoint.dir. Only a local session, whose tasks share the
    driver's files, may do without that setting: there it is a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{os.path.join(tempfile.gettempdir(), 'checkpoints')}"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: lineage ends in files that every
    executor can reach, so losing an executor costs one read and not a recomputation. made collects the frames to drop."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    if made is not None:
        made.append(out)
    return out


def drop_cut(*frames: DataFrame) -> None:
    """Delete the files behind frames that cut() returned."""
    for df in frames:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def dropping(made: list[DataFrame]) -> Iterator[None]:
    """Deletes the files behind made when the block ends, also by an error; frames may still be added to it."""
    try:
        yield
    finally:
        drop_cut(*made)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """df, marked for broadcast if it has so many rows at most."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Offsets of ranked() (a row for each group and partition) up to so many rows are broadcast.
BROADCAST_OFFSETS = 100_000


def ranked(df: DataFrame, order: list[Column], group: tuple[str, ...] = ()) -> DataFrame:
    """df with rank, from 1 in each group (columns that are never null): a sort over range partitions, whose rows count on from
    the rows that the partitions before hold of the group. No task gets a whole group. The sorted table is written."""
    keys = [*[F.col(g) for g in group], *order]
    own = {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    placed = cut(df.repartitionByRange(shuffle_width(df.sparkSession), *keys).sortWithinPartitions(*keys).withColumns(own))
    runs = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("rank")
    return placed.join(bounded(runs, BROADCAST_OFFSETS), [*group, "_part"]).select(*df.columns, rank)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The session's batches fit for long texts while jobs run inside: Arrow batches of 2 MB (not 64 MB) to Python workers, and
    256 rows (not 4,096) from Parquet. Both bound what a task holds at once, in the JVM and in Python; results don't
    depend on them. The session's own values come back at the end."""
    before = {name: spark.conf.get(name) for name in BATCHES}
    for name, small in BATCHES.items():
        spark.conf.set(name, small)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def lean(run):
    """run, a function of an iterator of batches, that gives its memory back to the system when it ends: Python workers
    live on between tasks and would keep their peak."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return wrapped
