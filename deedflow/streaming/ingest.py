"""Incremental ingestion: new snapshot files as a stream, upserted into partitioned Parquet.

The file source's checkpoint is the ledger of files seen. Each micro-batch is upserted by title and month into the
partitions it touches: the old partitions and the batch are merged, written aside and then put in place, so a
replayed batch gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dates
from ..operators.joins import bounded
from ..operators.upsert import upsert
from ..sources.tables import write_partitions
from ..sources.titles import KEY, LOAD_ORDER, from_header, parse_titles


def upsert_batch(path: str, keys: list[str] = KEY, order: list[str] = LOAD_ORDER, by: str = "file_month"):
    """A foreachBatch function that merges a batch into the table at path."""

    def run(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        # Rows that order leaves equal go by their place in the batch: a file is read by one task, in its order.
        columns, batch = batch.columns, batch.withColumn("_place", F.monotonically_increasing_id())
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(where):
            old = spark.read.schema(batch.drop("_place").schema).parquet(path).join(bounded(batch.select(by).distinct()), by, "left_semi")
        else:
            old = batch.drop("_place").limit(0)
        aside = f"{path}_epoch_{epoch}"
        upsert(old.select(*columns), batch, keys, [*order, "_place"]).write.mode("overwrite").parquet(aside)
        write_partitions(spark.read.schema(batch.drop("_place").schema).parquet(aside), path, by)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(aside), True)

    return run


def title_files(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """Snapshot rows of the CSV files that arrive in a folder; columns are their headers, in file order."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.readStream.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(folder)
    # A stream has no row number: within a file, the change date orders rows of one key, then their place in it.
    raw = raw.withColumn("_file", F.col("_metadata.file_name"))
    order = F.coalesce(F.unix_date(dates.snapshot_date(from_header(raw, "Change Date"))), F.lit(0)).cast("long")
    return parse_titles(raw, F.col("_file"), row_no=order)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take all files there are, in batches, and stop; the next call goes on from the checkpoint."""
    return stream.writeStream.foreachBatch(upsert_batch(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(ledger: DataFrame, minutes: int = 5) -> DataFrame:
    """Rows by window of arrival, late ones up to an hour: works on a stream and on a table."""
    timed = ledger.withWatermark("at", "1 hour") if ledger.isStreaming else ledger
    return timed.groupBy(F.window("at", f"{minutes} minutes").alias("window"), "status").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))


def match_missing(stream: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows of a stream whose id has no match yet (stream-static anti join)."""
    return stream.join(matched.select("id").distinct(), "id", "left_anti")
