"""Monthly title snapshots (CSV): full files and change-only files, with an import ledger."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.joins import bounded
from ..operators.upsert import drop_deletes, upsert_in_one_pass

# The headers of a snapshot file, in file order, and their columns.
PLAIN = {"Title Number": "title_number", "Tenure": "tenure", "Property Address": "property_address", "District": "district", "County": "county", "Region": "region", "Postcode": "postcode"}
FLAGS = {"Multiple Address Indicator": "multiple_address_indicator", "Additional Proprietor Indicator": "additional_proprietor_indicator", "Change Indicator": "change_indicator"}
SLOTTED = {
    "Proprietor Name ({})": "proprietor_{}_name",
    "Company Registration No. ({})": "company_{}_reg_no",
    "Proprietorship Category ({})": "proprietorship_{}_category",
    "Country Incorporated ({})": "country_{}_incorporated",
    "Proprietor ({}) Address (1)": "proprietor_{}_address_1",
    "Proprietor ({}) Address (2)": "proprietor_{}_address_2",
    "Proprietor ({}) Address (3)": "proprietor_{}_address_3",
}
FILE_NAME = r"(CCOD|OCOD)_(FULL|COU)_(\d{4})_(\d{2})"
KEY = ["title_number", "file_month"]
#: Files load by dataset, then name, then place in the file; of one key the last wins.
LOAD_ORDER = ["dataset_type", "source_filename", "row_no"]


def headers(frame: DataFrame) -> DataFrame:
    """Column names without outer white space."""
    return frame.toDF(*[c.strip() for c in frame.columns])


def from_header(frame: DataFrame, name: str) -> Column:
    """A column by its header; null where a file lacks it."""
    return F.col(f"`{name}`") if name in frame.columns else F.lit(None).cast("string")


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", null: str | None = None, only: str | None = None) -> DataFrame:
    """A header-bound CSV as strings; quoted fields may hold line ends. only: of a folder, files whose names have this in them
    are listed, and no others opened."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("sep", sep).option("enforceSchema", False)
    if only is not None:
        reader = reader.option("pathGlobFilter", f"*{re.sub(r'([][{}*?\\])', r'\\\1', only)}*")
    return headers((reader.option("nullValue", null) if null is not None else reader).csv(path))


def file_facts(name: Column) -> dict[str, Column]:
    """Dataset, kind and month out of a file name; null where it doesn't fit."""
    part = lambda i: F.nullif(F.regexp_extract(name, FILE_NAME, i), F.lit(""))
    return {"dataset_type": part(1), "update_type": part(2), "file_month": F.try_to_date(F.concat(part(3), part(4)), "yyyyMM")}


def parse_titles(raw: DataFrame, file_name: Column, keep_deletes: bool = False, row_no: Column | None = None) -> DataFrame:
    """Snapshot rows with typed columns; rows of files whose names don't parse go."""
    columns = {new: text.clean(from_header(raw, old)) for old, new in PLAIN.items()}
    columns |= {new: from_header(raw, old) for old, new in FLAGS.items()}
    columns |= {new.format(i): text.clean(from_header(raw, old.format(i))) for i in range(1, 5) for old, new in SLOTTED.items()}
    columns |= {
        "price_paid": text.strip(from_header(raw, "Price Paid")).try_cast("long"),
        "date_proprietor_added": dates.snapshot_date(from_header(raw, "Date Proprietor Added")),
        "change_date": dates.snapshot_date(from_header(raw, "Change Date")),
        "source_filename": file_name,
        "row_no": F.monotonically_increasing_id() if row_no is None else row_no,
    }
    parsed = raw.select(*[c.alias(n) for n, c in columns.items()], *[c.alias(n) for n, c in file_facts(file_name).items()])
    return drop_deletes(parsed.where("dataset_type is not null and file_month is not null"), keep_deletes)


def read_titles(spark: SparkSession, path: str, keep_deletes: bool = False, only: str | None = None) -> DataFrame:
    """Rows of a folder's snapshot files (those with `only` in their names). Files load in the order of their names, whatever
    task reads them: LOAD_ORDER says which row of a key is the last."""
    raw = read_csv(spark, path, only=only)
    return parse_titles(raw.withColumn("_file", F.col("_metadata.file_name")), F.col("_file"), keep_deletes)


def import_titles(table: DataFrame, ledger: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, ledger) after the files of new that the ledger lacks are upserted by title and month. The ledger has a row for each
    file: rows needn't be shuffled by their file, which would put each file's in one task."""
    fresh = new.join(bounded(ledger.where("status = 'completed'").select("source_filename").distinct()), "source_filename", "left_anti")
    entries = fresh.groupBy("source_filename", "file_month").agg(F.count("*").alias("rows")).withColumn("status", F.lit("completed"))
    merged = upsert_in_one_pass(table, fresh, KEY, LOAD_ORDER)
    return merged, ledger.unionByName(entries.select(*ledger.columns))


def split_titles(titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Properties and proprietors as two tables, keyed by id."""
    from ..operators.slots import OWNER, unpivot

    slotted = {p.format(i) for p in OWNER.values() for i in range(1, 5)}
    long = unpivot(titles)
    return titles.select(*[c for c in titles.columns if c not in slotted]), long.select("id", "slot", *OWNER, "date_proprietor_added")
