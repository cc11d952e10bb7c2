"""The import ledger: an append-only log of events, folded to one state for each file.

A file's life is running, then completed or failed. Nothing is updated in place: each step appends an event
(source_filename, status, at, run, rows, errors), and the state is what the fold of the events says, in whatever order they
were written. A run that dies leaves its file running; after a time it counts as abandoned and is taken again, as a failed one
is, up to a number of attempts. The first completion counts: what comes later of a file doesn't change it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source_filename string, status string, at timestamp, run string, rows long, errors long"
STATUSES = ("running", "completed", "failed")


def fold(events: DataFrame) -> DataFrame:
    """One row for each file: state, started_at, ended_at, attempts, run, rows, errors, completed_again (completions after the first).

    Events of a file are ordered by time, then running before the others, then by run. Aggregations only, with a map side."""
    known = events.where(F.col("status").isin(*STATUSES))
    order = F.struct("at", (F.col("status") != "running").alias("_end"), "run")
    event = F.struct("status", "at", "rows", "errors", "run")
    done = F.col("status") == "completed"
    first = F.min_by(F.when(done, event), F.when(done, order))
    out = known.groupBy("source_filename").agg(
        first.alias("_done"), F.max_by(event, order).alias("_last"), F.count_if(F.col("status") == "running").alias("attempts"),
        F.min(F.when(F.col("status") == "running", F.col("at"))).alias("started_at"),
        F.count_if(done).alias("_completions"),
    ).withColumn("_is", F.coalesce("_done", "_last"))
    open_, over = F.col("_is.status") == "running", F.col("_is.status") == "completed"
    return out.select(
        "source_filename", F.col("_is.status").alias("state"), "started_at", F.when(~open_, F.col("_is.at")).alias("ended_at"), "attempts", F.col("_is.run").alias("run"),
        F.when(over, F.coalesce("_is.rows", F.lit(0))).otherwise(0).alias("rows"), F.when(open_, 0).otherwise(F.coalesce("_is.errors", F.lit(0))).alias("errors"),
        F.when(over, F.col("_completions") - 1).otherwise(0).alias("completed_again"),
    )


def to_import(files: DataFrame, events: DataFrame, as_of: datetime, stale_minutes: int = 60, attempts: int = 3) -> DataFrame:
    """files (source_filename, ...) to take now, with why: new, failed or abandoned (running, and nothing heard of it for
    stale_minutes). Files that failed `attempts` times are left alone."""
    state = fold(events).select("source_filename", "state", "attempts")
    heard = events.groupBy("source_filename").agg(F.max("at").alias("_heard"))
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(stale_minutes))
    why = (
        F.when(F.col("state").isNull(), "new")
        .when((F.col("state") == "failed") & (F.col("attempts") < attempts), "failed")
        .when((F.col("state") == "running") & (F.col("_heard") < limit) & (F.col("attempts") < attempts), "abandoned")
    )
    joined = files.join(state, "source_filename", "left").join(heard, "source_filename", "left")
    return joined.withColumn("why", why).where("why is not null").select(*files.columns, "why")


def append(spark: SparkSession, log: str, events: Iterable[tuple]) -> None:
    """Adds events (tuples as in SCHEMA) to the log; one file, written whole or not at all."""
    spark.createDataFrame(list(events), SCHEMA).coalesce(1).write.mode("append").parquet(log)


def read(spark: SparkSession, log: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(SCHEMA).parquet(log) if there else spark.createDataFrame([], SCHEMA)


def run_imports(spark: SparkSession, log: str, files: list[str], work: Callable[[str], int], now: Callable[[], datetime], stale_minutes: int = 60, attempts: int = 3) -> dict[str, str]:
    """Imports the files that the ledger says are to be taken, each by work(file), which returns its rows and may be repeated
    (an upsert). Returns what became of each. An exception fails its file and the next is tried; a kill leaves it running."""
    there = spark.createDataFrame([(f,) for f in files], "source_filename string")
    todo = sorted(r.source_filename for r in to_import(there, read(spark, log), now(), stale_minutes, attempts).collect())
    out = {}
    for name in todo:
        run = uuid.uuid4().hex
        append(spark, log, [(name, "running", now(), run, None, None)])
        try:
            rows = work(name)
        except Exception:
            append(spark, log, [(name, "failed", now(), run, None, 1)])
            out[name] = "failed"
        else:
            append(spark, log, [(name, "completed", now(), run, rows, 0)])
            out[name] = "completed"
    return out
