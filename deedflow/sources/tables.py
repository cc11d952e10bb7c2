"""Table storage on Parquet, connectors and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, by: str = "file_month") -> None:
    """Replace the partitions that df has rows of, and no others. df must not read from path."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def reload(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A stored view: the table is written anew and read."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One CSV file with a header, for reports of bounded size."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_rows(df: DataFrame):
    """Rows one at a time, with one partition in the driver at once."""
    return df.toLocalIterator(prefetchPartitions=False)


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 8, **options) -> DataFrame:
    """A table of another database; with a numeric key it is read in ranges, in parallel, each with about as many rows.

    The ranges end at quantiles of the key, so that gaps and crowds in it don't make idle or overfull tasks: the key alone is
    read first, in equal widths between its ends, and its quantiles are estimated (the driver gets parts - 1 numbers). Rows without a key are in the
    first range. The database sees one query for each range, with the pruned columns and pushed filters of the plan."""

    def read(**more) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, **options, **more).load()

    if not key:
        return read(dbtable=table)
    ends = read(query=f"SELECT MIN({key}) AS LOW, MAX({key}) AS HIGH FROM {table}").first()
    if ends[0] is None:
        return read(dbtable=table)
    low, high = int(ends[0]), int(ends[1]) + 1
    keys = read(dbtable=table, partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)).select(F.col(key).cast("double").alias("k"))
    cuts = sorted(set(keys.approxQuantile("k", [i / parts for i in range(1, parts)], 1 / (20 * parts))))
    # A range begins after the last key of the one before, so that a cut on a repeated key leaves all its rows in one range.
    whole = [int(c) for c in cuts if c < ends[1]]
    if not whole:
        return read(dbtable=table)
    where = [f"{key} <= {whole[0]} OR {key} IS NULL", *[f"{key} > {a} AND {key} <= {b}" for a, b in zip(whole, whole[1:], strict=False)], f"{key} > {whole[-1]}"]
    return spark.read.jdbc(url, table, predicates=where, properties={k: str(v) for k, v in options.items()})


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def register_lookup(spark: SparkSession, view: str, name: str = "ownership_history", keys: dict[str, str] | None = None) -> None:
    """A SQL table function over a view for SQL clients: SELECT * FROM ownership_history(title => 'T1').

    Each argument (name -> column) may be left out. Arguments are constants when a query is planned, so the tests of those left out
    fold away and the others are filters that reach the scan."""
    keys = keys or {"title": "title_number", "company": "matched_number", "postcode": "postcode", "month": "file_month"}
    schema = spark.table(view).schema
    params = ", ".join(f"`{a}` {schema[c].dataType.simpleString()} DEFAULT NULL" for a, c in keys.items())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    tests = " AND ".join(f"({name}.`{a}` IS NULL OR v.`{c}` = {name}.`{a}`)" for a, c in keys.items())
    shown = ", ".join(f"v.`{f.name}`" for f in schema)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE ({columns}) RETURN SELECT {shown} FROM {view} AS v WHERE {tests}")


def ledger_entry(spark: SparkSession, name: str, status: str, rows: int = 0, errors: int = 0) -> DataFrame:
    """One row of the import ledger: running, completed or failed."""
    if status not in ("running", "completed", "failed"):
        raise ValueError(status)
    return spark.createDataFrame([(name, status, rows, errors)], "source_filename string, status string, rows long, errors long").withColumn("at", F.current_timestamp())
