"""Company pages: blobs of (compressed) HTML, and their facts as rows.

Blobs come from files (one page each) or a binary column. Python workers get them in Arrow batches, which Spark bounds by bytes
(spark.sql.execution.arrow.maxBytesPerBatch), and decode one page at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, html, labels

CHARGE_FIELDS = ["code", "status", "created_on", "delivered_on", "satisfied_on", "persons_entitled", "description"]
#: Charges of one output batch.
ROWS = 4096


def read_blobs(spark: SparkSession, folder: str, suffix: str = ".html.bz2") -> DataFrame:
    """company_number (of the file name), page (bytes) of the files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.substring(name, 1, F.length(name) - len(suffix)).alias("company_number"), F.col("content").alias("page"))


def overviews(pages: DataFrame, key: str = "company_number", page: str = "page") -> DataFrame:
    """key and the facts of an overview page, days as dates."""
    out = pages.select(key, html.overview_of(F.col(page)).alias("_o")).select(key, "_o.*")
    return out.withColumns({c: dates.scraped_date(F.col(c)) for c in ("incorporated_on", "accounts_due", "statement_due")})


def charge_lists(pages: DataFrame, key: str = "company_number", page: str = "page") -> DataFrame:
    """One row for each charge of a company's list: key, charge_id (number of the company and place in the list), what the
    block says, days as dates, and the type that its description shows."""
    kind = pages.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _no int, code string, status string, created_on string, delivered_on string, satisfied_on string, persons_entitled array<string>, description string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(2 + len(CHARGE_FIELDS))]
            for i in range(b.num_rows):
                for no, charge in enumerate(html.charges(b["_page"][i].as_py()), 1):
                    for column, value in zip(out, (b["_key"][i].as_py(), no, *[charge[f] for f in CHARGE_FIELDS]), strict=True):
                        column.append(value)
                    if len(out[0]) >= ROWS:
                        yield _batch(out, b["_key"].type)
                        out = [[] for _ in out]
            if out[0]:
                yield _batch(out, b["_key"].type)

    found = pages.select(F.col(key).alias("_key"), F.col(page).alias("_page")).mapInArrow(rows, schema)
    days = {c: dates.scraped_date(F.col(c)) for c in ("created_on", "delivered_on", "satisfied_on")}
    named = found.withColumns({"charge_id": F.concat(F.col("_key").cast("string"), F.lit("_charge_"), F.col("_no").cast("string")), "charge_type": labels.charge_kind(F.col("description")), **days})
    return named.select(F.col("_key").alias(key), "charge_id", "charge_type", *CHARGE_FIELDS)


def _batch(columns: list[list], key: pa.DataType) -> pa.RecordBatch:
    types = [key, pa.int32(), *[pa.list_(pa.string()) if f == "persons_entitled" else pa.string() for f in CHARGE_FIELDS]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["_key", "_no", *CHARGE_FIELDS])


def charge_details(pages: DataFrame, key: str = "company_number", page: str = "page") -> DataFrame:
    """key and the facts of a charge's own page, days as dates."""
    out = pages.select(key, html.charge_of(F.col(page)).alias("_c")).select(key, "_c.*")
    return out.withColumns({c: dates.scraped_date(F.col(c)) for c in ("created_on", "delivered_on", "satisfied_on")})
