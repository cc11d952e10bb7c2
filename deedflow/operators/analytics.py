"""Portfolio, price, geographic and activity aggregates, and data-quality checks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, labels, text
from .timeline import listed


def whole(c: Column) -> Column:
    """Average as a whole number."""
    return F.round(F.avg(c), 0)


def share(part: Column, total: Column) -> Column:
    return F.round(100.0 * part / F.nullif(total, F.lit(0)), 2)


def property_summary(t: DataFrame) -> DataFrame:
    return t.select(
        "id", "title_number", text.outward_postcode(F.col("postcode")).alias("postcode_area"), F.year("change_date").alias("change_year"), F.month("change_date").alias("change_month"),
        dates.year_month(F.col("change_date")).alias("year_month"), labels.price_band(F.col("price_paid")).alias("price_band"),
        F.when(F.col("multiple_address_indicator") == "Y", "Multiple").otherwise("Single").alias("address_type"),
    )


def monthly_stats(t: DataFrame) -> DataFrame:
    price = F.col("price_paid")
    return t.groupBy("dataset_type", "file_month").agg(
        F.count("*").alias("property_count"), F.count(price).alias("properties_with_price"), whole(price).alias("avg_price"), F.sum(price).alias("total_value"),
        F.count_distinct("district").alias("unique_districts"), F.count_distinct(text.outward_postcode(F.col("postcode"))).alias("unique_postcode_areas"),
    ).withColumns({"year_month": dates.year_month(F.col("file_month")), "year": F.year("file_month"), "month": F.month("file_month")})


def geographic_stats(t: DataFrame) -> DataFrame:
    price = F.col("price_paid")
    return t.where("region <> '' and county <> ''").groupBy("dataset_type", "region", "county", "district").agg(
        F.count("*").alias("property_count"), F.count(price).alias("properties_with_price"), whole(price).alias("avg_price"), F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.count_distinct("postcode").alias("unique_postcodes"), F.count_distinct("title_number").alias("unique_properties"),
    )


def company_stats(long: DataFrame) -> DataFrame:
    """Per registration number; equal prices count once in the value."""
    out = long.where(F.col("company_reg_no").isNotNull()).groupBy("company_reg_no").agg(
        F.max("proprietor_name").alias("company_name"), F.max("category").alias("category"), F.max("country_incorporated").alias("country"),
        F.count_distinct("title_number").alias("property_count"), F.sum_distinct(F.col("price_paid")).alias("total_value_owned"),
        F.min("date_proprietor_added").alias("first_seen_date"), F.max("date_proprietor_added").alias("last_seen_date"),
    )
    return out.withColumns({"company_type": F.when(F.col("country").isNotNull(), "Overseas").otherwise("UK"), "portfolio_size": labels.portfolio_band(F.col("property_count"))})


def price_trends(t: DataFrame, since: int = 2018) -> DataFrame:
    """Averages and exact percentiles, interpolated, from the counts of equal prices: a group's prices are sorted in a window, which
    can spill, and not held in one aggregate's memory."""
    keys, price, year = ["dataset_type", "region", "year"], F.col("price_paid"), F.year("change_date")
    kept = t.where((price > 0) & (F.col("region") != "") & (year >= since))
    counted = kept.groupBy("dataset_type", "region", year.alias("year"), "price_paid").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    placed = counted.withColumns({"_upto": F.sum("_n").over(group.orderBy("price_paid")), "_rows": F.sum("_n").over(group)})

    def at(p: float) -> Column:
        place = F.lit(p) * (F.col("_rows") - 1)
        low, high = (F.min(F.when(F.col("_upto") > side(place), price)).cast("double") for side in (F.floor, F.ceil))
        return F.round(low + (high - low) * F.max(place - F.floor(place)), 0)

    return placed.groupBy(*keys).agg(
        F.sum("_n").alias("transaction_count"), F.round(F.sum(price.cast("double") * F.col("_n")) / F.sum("_n"), 0).alias("avg_price"),
        *[at(p).alias(n) for p, n in ((0.5, "median_price"), (0.25, "price_25th_percentile"), (0.75, "price_75th_percentile"))],
    )


def recent_activity(t: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    return t.where(F.col("change_date") >= F.add_months(F.lit(as_of), -months)).groupBy("dataset_type", "change_date", "change_indicator").agg(
        F.count("*").alias("property_count"), F.count("price_paid").alias("priced_properties"), whole(F.col("price_paid")).alias("avg_price"), F.count_distinct("county").alias("counties_affected"), F.count_distinct("district").alias("districts_affected"),
    )


def company_titles(long: DataFrame) -> DataFrame:
    """A row for each title of each company: company_properties() without its list, whose length has no bound."""
    number = F.coalesce("matched_number", "company_reg_no").alias("company_number")
    return long.select("*", number, F.coalesce("ch_company_name", "proprietor_name").alias("company_name")).where("company_number is not null").groupBy("company_number", "company_name", "title_number").agg(
        F.sum("price_paid").alias("total_price_paid"), F.min("date_proprietor_added").alias("earliest_acquisition"), F.max("date_proprietor_added").alias("latest_acquisition"),
    )


def company_properties(long: DataFrame) -> DataFrame:
    number = F.coalesce("matched_number", "company_reg_no").alias("company_number")
    return long.select("*", number, F.coalesce("ch_company_name", "proprietor_name").alias("company_name")).where("company_number is not null").groupBy("company_number", "company_name").agg(
        F.count_distinct("title_number").alias("property_count"), listed(F.col("title_number")).alias("title_numbers"), F.sum("price_paid").alias("total_price_paid"),
        F.min("date_proprietor_added").alias("earliest_acquisition"), F.max("date_proprietor_added").alias("latest_acquisition"),
    )


def match_quality_by_region(long: DataFrame) -> DataFrame:
    kind, total = F.col("match_type"), F.count("*")
    matched = F.count_if(F.coalesce(~kind.isin("No_Match", "Land_Registry", "Not_Company"), F.lit(False)))
    return long.groupBy("region").agg(total.alias("total_proprietors"), matched.alias("matched"), *[F.count_if(kind == k).alias(n) for k, n in (("Name+Number", "name_number"), ("Number", "number_only"), ("Name", "name_only"), ("Previous_Name", "previous_name"))], share(matched, total).alias("match_rate"))


def match_summary(long: DataFrame) -> DataFrame:
    """Counts over all slots: title rows are told apart by id."""
    kind = F.col("match_type")
    some = F.coalesce(kind != "No_Match", F.lit(False))
    return long.agg(
        F.count_distinct("id").alias("total_properties"), F.count_distinct(F.when(some, F.col("title_number"))).alias("properties_with_matches"),
        *[F.count_if((F.col("slot") == 1) & (kind == k)).alias(n) for k, n in (("Name+Number", "prop1_name_number_matches"), ("Number", "prop1_number_matches"), ("Name", "prop1_name_matches"), ("Previous_Name", "prop1_previous_name_matches"), ("No_Match", "prop1_no_matches"))],
        F.count_if(some).alias("total_proprietor_matches"),
    )


def not_in_with_null(long: DataFrame, strict: bool = True, rows: Column | None = None) -> DataFrame:
    """Matched counts by a NOT IN list that holds a null: it is never true, so the count is 0. strict=False drops the null.
    rows: how many rows one of long stands for."""
    n = F.lit(1) if rows is None else rows
    test = F.expr("match_type NOT IN ('No_Match', CAST(NULL AS STRING))") if strict else F.expr("match_type <> 'No_Match'")
    return long.groupBy("slot").agg(F.sum(F.when(test, n).otherwise(0)).alias("matched"), F.sum(n).alias("total"))


def status_shares(t: DataFrame, column: str = "ownership_status") -> DataFrame:
    counted = t.groupBy(column).agg(F.count("*").alias("records"))
    # Windowed over the groups, not the rows.
    return counted.withColumn("percentage", F.round(100.0 * F.col("records") / F.sum("records").over(Window.partitionBy()), 2))


def snapshot_profile(t: DataFrame) -> DataFrame:
    return t.groupBy("file_month", "update_type", "dataset_type").agg(F.count("*").alias("records"), F.count_distinct("title_number").alias("titles"), F.count_if(F.col("change_indicator") == "A").alias("added"), F.count_if(F.col("change_indicator") == "D").alias("deleted"))


def top_per_group(t: DataFrame, group: str, order: list[Column], k: int = 10) -> DataFrame:
    return t.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rn") <= k)


def unmatched_reasons(long: DataFrame) -> DataFrame:
    """Unmatched owners by the class of their number, or of their name where they have none."""
    left = long.where("match_type in ('No_Match', 'Land_Registry')")
    numbered = text.present(F.col("company_reg_no"))
    return left.groupBy(F.when(numbered, labels.number_class(F.col("company_reg_no"))).otherwise(labels.owner_class(F.upper("proprietor_name"))).alias("reason"), numbered.alias("has_number")).agg(F.count("*").alias("records"), F.count_distinct("proprietor_name").alias("names"))


def duplicate_names(companies: DataFrame, least: int = 2) -> DataFrame:
    key = text.name_key_ascii(F.col("company_name"))
    shown = F.concat("company_name", F.lit(" ("), "company_number", F.lit(")"))
    return companies.groupBy(key.alias("normalized")).agg(F.count("*").alias("company_count"), F.array_join(F.array_sort(F.collect_list(shown)), "; ").alias("companies")).where(F.col("normalized") != "").where(F.col("company_count") >= least)


def interval_checks(intervals: DataFrame) -> DataFrame:
    """One row per rule, with the number of intervals that break it; one scan."""
    rules = {"Previous without end date": "ownership_status = 'Previous' and ownership_end_date is null", "Missing start date": "ownership_start_date is null", "Negative duration": "ownership_duration_days < 0", "Current with end date": "ownership_status = 'Current' and ownership_end_date is not null"}
    counts = intervals.agg(*[F.count_if(F.expr(r)).alias(f"c{i}") for i, r in enumerate(rules.values())])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("issue"), F.col(f"c{i}").alias("records")) for i, n in enumerate(rules)])))


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other table lacks."""
    return left.join(right, keys, "left_anti")


def duplicates(t: DataFrame, keys: list[str]) -> DataFrame:
    return t.groupBy(*keys).agg(F.count("*").alias("records")).where("records > 1")


def pick_test_companies(t: DataFrame, titles: int = 5, most: int = 20) -> DataFrame:
    """Owners with several titles and snapshots, some of them sold."""
    sold = F.count_distinct(F.when(F.col("ownership_status") == "Historical", F.col("title_number")))
    out = t.groupBy("proprietor_name").agg(F.count_distinct("title_number").alias("titles"), F.count_distinct("file_month").alias("snapshots"), sold.alias("sold"))
    return out.where((F.col("titles") >= titles) & (F.col("snapshots") > 1) & (F.col("sold") > 0)).orderBy(F.desc("titles"), "proprietor_name").limit(most)


def filled(t: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null counts and greatest lengths, a row per column, in one scan."""
    row = t.agg(*[x for c in columns for x in (F.count(c).alias(f"n_{c}"), F.max(F.length(F.col(c).cast("string"))).alias(f"l_{c}"))])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("filled"), F.col(f"l_{c}").alias("longest")) for c in columns])))


def charges_report(charges: DataFrame, company: str) -> DataFrame:
    """A company's charges, without page artefacts, outstanding and satisfied told apart, newest first."""
    return charges.where((F.col("company_number") == company) & ~F.col("charge_id").like("page\\_%")).withColumn("outstanding", F.lower("status") == "outstanding").orderBy(F.desc("outstanding"), F.desc_nulls_last("created_date"), "charge_id")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
