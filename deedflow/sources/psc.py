"""Persons with significant control: JSON lines to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, labels
from ..operators.upsert import upsert

SCHEMA = """company_number string, data struct<kind:string, name:string, name_elements:struct<title:string,forename:string,middle_name:string,surname:string>,
 date_of_birth:struct<year:int,month:int>, country_of_residence:string, nationality:string,
 address:struct<care_of:string,po_box:string,premises:string,address_line_1:string,address_line_2:string,locality:string,region:string,country:string,postal_code:string>,
 identification:struct<legal_form:string,legal_authority:string,place_registered:string,country_registered:string,registration_number:string>,
 natures_of_control:array<string>, notified_on:string, ceased_on:string, etag:string, links:string>, _corrupt string"""
NAME, ADDRESS = ("title", "forename", "middle_name", "surname"), ("care_of", "po_box", "premises", "address_line_1", "address_line_2", "locality", "region", "country", "postal_code")
IDENTITY = ("legal_form", "legal_authority", "place_registered", "country_registered", "registration_number")


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of value lines; blank lines and records without a number or data go."""
    parsed = lines.where(F.trim("value") != "").withColumn("_r", F.from_json("value", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = parsed.where("_r._corrupt is null and coalesce(_r.company_number, '') <> '' and _r.data is not null")
    return good.select(*[c for c in lines.columns if c != "value"], "_r.company_number", "_r.data"), parsed.where("_r._corrupt is not null").select("value")


def flatten(records: DataFrame) -> DataFrame:
    d = lambda f: F.col(f"data.{f}")
    return records.select(
        *[c for c in records.columns if c != "data"],
        d("kind").alias("psc_type"),
        labels.psc_kind(F.coalesce(d("kind"), F.lit("unknown"))).alias("psc_kind"),
        d("name").alias("name"),
        *[d(f"name_elements.{f}").alias(f"name_{f}") for f in NAME],
        d("date_of_birth.year").alias("birth_year"),
        d("date_of_birth.month").alias("birth_month"),
        *[d(f"address.{f}").alias(f if f.startswith("address") else f"address_{f}") for f in ADDRESS],
        d("country_of_residence").alias("country_of_residence"),
        d("nationality").alias("nationality"),
        *[d(f"identification.{f}").alias(f"identification_{f}") for f in IDENTITY],
        d("natures_of_control").alias("natures_of_control"),
        dates.iso_date(d("notified_on")).alias("notified_on"),
        dates.iso_date(d("ceased_on")).alias("ceased_on"),
        d("etag").alias("etag"),
        d("links").alias("links"),
    )


def read_psc(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("source_filename", F.col("_metadata.file_name"))
    return flatten(parse_lines(lines)[0])


def import_psc(table: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by company and etag; a null etag never replaces a row."""
    return upsert(table, new, ["company_number", "etag"], ["source_filename"], null_keys_repeat=True)


def active_per_company(psc: DataFrame) -> DataFrame:
    return psc.where("ceased_on is null").groupBy("company_number").agg(F.count("*").alias("active_psc"))


def top_countries(psc: DataFrame, k: int = 10) -> DataFrame:
    return psc.where("country_of_residence is not null").groupBy("country_of_residence").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "country_of_residence").limit(k)


def of_active_companies(psc: DataFrame, companies: DataFrame) -> DataFrame:
    return psc.join(companies.where("company_status = 'Active'").select("company_number", "company_name"), "company_number")
