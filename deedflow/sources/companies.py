"""The company register (CSV), scraped search results, and merges of the two."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from .titles import from_header, headers, read_csv

# Register headers and their columns.
STRINGS = {
    "CompanyName": "company_name", "RegAddress.CareOf": "reg_address_care_of", "RegAddress.POBox": "reg_address_po_box", "RegAddress.AddressLine1": "reg_address_line1", "RegAddress.AddressLine2": "reg_address_line2",
    "RegAddress.PostTown": "reg_address_post_town", "RegAddress.County": "reg_address_county", "RegAddress.Country": "reg_address_country", "RegAddress.PostCode": "reg_address_postcode",
    "CompanyCategory": "company_category", "CompanyStatus": "company_status", "CountryOfOrigin": "country_of_origin", "Accounts.AccountRefDay": "accounts_ref_day", "Accounts.AccountRefMonth": "accounts_ref_month",
    "Accounts.AccountCategory": "accounts_category", "SICCode.SicText_1": "sic_code_1", "SICCode.SicText_2": "sic_code_2", "SICCode.SicText_3": "sic_code_3", "SICCode.SicText_4": "sic_code_4",
    "LimitedPartnerships.NumGenPartners": "num_gen_partners", "LimitedPartnerships.NumLimPartners": "num_lim_partners", "URI": "uri",
}
DATES = {
    "DissolutionDate": "dissolution_date", "IncorporationDate": "incorporation_date", "Accounts.NextDueDate": "accounts_next_due_date", "Accounts.LastMadeUpDate": "accounts_last_made_up_date",
    "Returns.NextDueDate": "returns_next_due_date", "Returns.LastMadeUpDate": "returns_last_made_up_date", "ConfStmtNextDueDate": "conf_stmt_next_due_date", "ConfStmtLastMadeUpDate": "conf_stmt_last_made_up_date",
}
COUNTS = {"Mortgages.NumMortCharges": "mortgages_num_charges", "Mortgages.NumMortOutstanding": "mortgages_num_outstanding", "Mortgages.NumMortPartSatisfied": "mortgages_num_part_satisfied", "Mortgages.NumMortSatisfied": "mortgages_num_satisfied"}
SCRAPED = {"Search Name": "search_name", "Status": "search_status", "Found Name": "company_name", "Company Number": "company_number", "Company Type": "company_category", "Company Status": "company_status", "Registered Office Address": "reg_address_full", "SIC Codes": "sic_text", "Previous Names": "previous_text", "Incorporated On": "incorporated_on", "Accounts Next Due": "accounts_due", "Confirmation Statement Next Due": "statement_due"}


def latest_file(paths: list[str], stem: str = "BasicCompanyDataAsOneFile") -> str:
    """The newest register file, by name."""
    named = [p for p in paths if p.rsplit("/", 1)[-1].startswith(stem) and p.endswith(".csv")]
    if not named:
        raise FileNotFoundError(f"no file named {stem}*.csv")
    return max(named, key=lambda p: p.rsplit("/", 1)[-1])


def parse_companies(raw: DataFrame) -> DataFrame:
    """Typed register rows; previous names are an array of (name, changed_on). Rows without a number go."""
    raw = headers(raw)
    old = F.array(*[F.struct(text.clean_none(from_header(raw, f"PreviousName_{i}.CompanyName")).alias("name"), dates.register_date(from_header(raw, f"PreviousName_{i}.CONDATE")).alias("changed_on")) for i in range(1, 11)])
    number = text.clean_none(from_header(raw, "CompanyNumber"))
    return raw.select(
        number.alias("company_number"),
        *[text.clean_none(from_header(raw, h)).alias(c) for h, c in STRINGS.items()],
        *[dates.register_date(from_header(raw, h)).alias(c) for h, c in DATES.items()],
        *[text.strip(from_header(raw, h)).try_cast("int").alias(c) for h, c in COUNTS.items()],
        F.filter(old, lambda p: p["name"].isNotNull()).alias("previous_name_changes"),
    ).where("company_number is not null").withColumn("previous_names", F.transform("previous_name_changes", lambda p: p["name"]))


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    return parse_companies(read_csv(spark, path))


def parse_scraped(raw: DataFrame) -> DataFrame:
    """Search results under either spelling of their headers (Status, status; Found Name, found_name)."""
    raw = headers(raw)
    by_name = {c.lower().replace(" ", "_"): c for c in raw.columns}
    columns = {new: text.clean(F.col(f"`{by_name[k]}`")) if (k := old.lower().replace(" ", "_")) in by_name else F.lit(None).cast("string") for old, new in SCRAPED.items()}
    out = raw.select(*[c.alias(n) for n, c in columns.items()])
    return out.withColumns({
        "sic_codes": text.sic_codes(F.col("sic_text")),
        "previous_names": text.split_list(F.col("previous_text")),
        "incorporation_date": dates.scraped_date(F.col("incorporated_on")),
        "accounts_next_due_date": dates.scraped_date(F.col("accounts_due")),
        "conf_stmt_next_due_date": dates.scraped_date(F.col("statement_due")),
    })


def merge_rescraped(main: DataFrame, again: DataFrame, name: str = "Search Name", state: str = "Status") -> DataFrame:
    """Rows of main in ERROR take the repeated search's row of that name (the last one), in its columns; others stay."""
    keep = [c for c in again.columns if c != "Original Error"]
    key = lambda f: F.lower(text.strip(f[name]))
    # Row numbers of a read follow the file, so the last row is the one that the file has last.
    numbered = again.withColumn("_row", F.monotonically_increasing_id())
    fresh = numbered.groupBy(key(numbered).alias("_k")).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in keep]), "_row").alias("_r"))
    use = F.col("_r").isNotNull() & (text.strip(F.col(f"`{state}`")) == "ERROR")
    joined = main.join(fresh, key(main) == F.col("_k"), "left")
    return joined.select(*[F.when(use, F.col("_r")[c]).otherwise(from_header(main, c)).alias(c) for c in keep])
