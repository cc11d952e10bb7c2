"""Timeline, interval and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import dates
from ..operators import analytics, intervals, resolve, slots, timeline
from .testdata import AS_OF, BASE, MATCHED, SQL_TITLES, companies, titles

DAY = f"DATE '{AS_OF.isoformat()}'"
MONTHS = "(CASE WHEN {e} >= {s} THEN (year({e}) - year({s})) * 12 + month({e}) - month({s}) - CASE WHEN day({e}) < day({s}) THEN 1 ELSE 0 END WHEN {e} < {s} THEN -((year({s}) - year({e})) * 12 + month({s}) - month({e}) - CASE WHEN day({s}) < day({e}) THEN 1 ELSE 0 END) END)"
OWNED = f"""{MATCHED}, tm AS (SELECT title_number, max(file_month) AS title_max_month FROM titles GROUP BY 1),
owners AS (SELECT m.*, title_max_month, c.company_name AS ch_company_name, c.company_status AS ch_company_status FROM matched m JOIN tm USING (title_number) LEFT JOIN companies c ON m.matched_number = c.company_number)"""
COMPANY = "category IN ('Limited Company or Public Limited Company', 'Limited Liability Partnership')"
RANK = "row_number() OVER (PARTITION BY title_number, {0}proprietor_name ORDER BY file_month DESC, id DESC)"
SCOPES = {
    "all": "true",
    "recent": "file_month >= (SELECT max(file_month) FROM owners) - INTERVAL 3 MONTH",
    "latest": "slot = 1 AND file_month = (SELECT max(file_month) FROM owners WHERE slot = 1)",
    "companies": f"file_month >= (SELECT max(file_month) FROM owners) - INTERVAL 3 MONTH AND {COMPANY} AND match_type <> 'Not_Company'",
    "companies_all": f"{COMPANY} AND coalesce(match_type, '') <> 'Not_Company' AND (date_proprietor_added IS NULL OR date_proprietor_added <= {DAY})",
}
STATUS = {
    "title_max": "file_month = title_max_month",
    "title_max_not_deleted": "file_month = title_max_month AND coalesce(change_indicator, '') <> 'D'",
    "global_max_not_deleted": "file_month = (SELECT max(file_month) FROM scoped) AND coalesce(change_indicator, '') <> 'D'",
    "recency_rank": "recency = 1 AND coalesce(change_indicator, '') <> 'D'",
}
# An owner in a later slot counts only after slots that are all filled, by others.
CROSS = "slot = 1 + (SELECT count(*) FROM owners o WHERE o.id = s.id AND o.slot < s.slot AND o.proprietor_name <> s.proprietor_name)"
DEDUP = {
    "none": "SELECT * FROM scoped",
    "per_slot_owner": f"SELECT * EXCLUDE (rn) FROM (SELECT *, {RANK.format('slot, ')} AS rn FROM scoped) WHERE rn = 1",
    "cross_slot_owner": f"SELECT * EXCLUDE (rn) FROM (SELECT *, {RANK.format('')} AS rn FROM scoped s WHERE {CROSS}) WHERE rn = 1",
}


def timeline_sql(name: str) -> str:
    v = timeline.VIEWS[name]
    if v.status == "date_based":
        status = f"CASE WHEN change_indicator = 'D' THEN 'Previous Owner' WHEN date_proprietor_added IS NULL THEN 'Current Owner - Date Unknown' WHEN date_proprietor_added <= {DAY} THEN 'Current Owner' ELSE 'Future Owner' END"
        months = MONTHS.format(e=DAY, s="date_proprietor_added")
    else:
        status = f"CASE WHEN {STATUS[v.status]} THEN 'Current' ELSE 'Historical' END"
        if v.status == "global_max_not_deleted":
            months = MONTHS.format(e=f"(CASE WHEN change_indicator = 'D'{'' if v.null_end else ' AND change_date IS NOT NULL'} THEN change_date ELSE {DAY} END)", s="date_proprietor_added")
        else:
            months = MONTHS.format(e=f"coalesce(change_date, {DAY})", s="coalesce(date_proprietor_added, file_month)")
    change = {"reference": "WHEN 'M' THEN 'Modified' ELSE 'Unchanged'", "updated": "WHEN 'U' THEN 'Updated' ELSE 'No Change'", "short": "ELSE 'No Change'"}[v.change_style]
    return f"""{OWNED}, scoped AS (SELECT * FROM owners WHERE {SCOPES[v.scope]} AND slot IN ({', '.join(map(str, v.slots))})), one AS ({DEDUP[v.dedup]}), ranked AS (SELECT *, {RANK.format('slot, ')} AS recency FROM one),
tl AS (SELECT *, {status} AS ownership_status, CASE change_indicator WHEN 'A' THEN 'Added' WHEN 'D' THEN 'Deleted' {change} END AS change_description,
 CASE match_type WHEN 'Name+Number' THEN 'Excellent' WHEN 'Number' THEN 'Very Good' WHEN 'Name' THEN 'Good' WHEN 'Previous_Name' THEN 'Fair' ELSE 'Unknown' END AS match_quality,
 CAST(row_number() OVER (PARTITION BY title_number, proprietor_name ORDER BY file_month, slot, id) AS INTEGER) AS ownership_sequence, CAST({months} AS INTEGER) AS ownership_duration_months FROM ranked)"""


COLUMNS = "id, slot, title_number, CAST(file_month AS VARCHAR) AS file_month, proprietor_name, matched_number, ownership_status, change_description, match_quality, ownership_sequence, ownership_duration_months"


def owners(spark, d):
    return timeline.resolved_owners(titles(spark, d), companies(spark, d))


def view(spark, d, name="corrected", match=True):
    # Of an owner's columns the queries ask for name and number alone.
    return timeline.resolved_timeline(titles(spark, d), companies(spark, d), name, AS_OF, only=(), match=match)


def view_by_title(spark, d, name="corrected"):
    """view(), for reports by title: its rows are shuffled by title last, where the reports find them."""
    return timeline.timeline(owners(spark, d).repartition("title_number"), name, AS_OF)


def matched_by_title(spark, d, match):
    """owners() with these columns of the match alone, which come to the titles: no owners' rows are shuffled."""
    return timeline.resolved_owners(titles(spark, d), companies(spark, d), deal=timeline.by_title, only=(), match=match)


def text_dates(df):
    return df.select(*[F.col(c).cast("string").alias(c) if t == "date" else F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def _register(name: str) -> None:
    def run(spark, d):
        return text_dates(view(spark, d, name).select("id", "slot", "title_number", "file_month", "proprietor_name", "matched_number", "ownership_status", "change_description", "match_quality", "ownership_sequence", "ownership_duration_months"))

    query(f"timeline_{name}", f"{timeline_sql(name)} SELECT {COLUMNS} FROM tl")(run)


for _name in timeline.VIEWS:
    _register(_name)
TL = timeline_sql("corrected")
NOW = "ownership_status = 'Current'"


@query("ownership_summary", f"""{TL} SELECT title_number, dataset_type, count(DISTINCT proprietor_name) AS total_unique_owners, count(DISTINCT file_month) AS ownership_records, CAST(min(file_month) AS VARCHAR) AS earliest_record, CAST(max(file_month) AS VARCHAR) AS latest_record,
 string_agg(DISTINCT CASE WHEN {NOW} THEN proprietor_name END, ', ' ORDER BY CASE WHEN {NOW} THEN proprietor_name END) AS current_owners, count(*) FILTER ({NOW}) AS current_owner_count, count(*) FILTER (confidence >= 0.9) AS high_confidence_matches,
 count(*) FILTER (confidence >= 0.7 AND confidence < 0.9) AS medium_confidence_matches, count(*) FILTER (confidence > 0 AND confidence < 0.7) AS low_confidence_matches, count(*) FILTER (coalesce(confidence, 0) = 0) AS no_matches FROM tl GROUP BY title_number, dataset_type""")
def ownership_summary(spark, d):
    return text_dates(timeline.summary(view_by_title(spark, d)))


@query("current_ownership", f"{TL} SELECT id, slot, title_number, proprietor_name FROM tl WHERE {NOW}")
def current_ownership(spark, d):
    return timeline.current(view(spark, d, match=False)).select("id", "slot", "title_number", "proprietor_name")


@query("latest_per_owner", f"{TL} SELECT id, slot, title_number, proprietor_name FROM (SELECT *, row_number() OVER (PARTITION BY title_number, proprietor_name ORDER BY file_month DESC, id DESC, slot) AS rn FROM tl) WHERE rn = 1")
def latest_per_owner(spark, d):
    return timeline.latest_per_owner(view(spark, d, match=False)).select("id", "slot", "title_number", "proprietor_name")


@query("recent_changes", f"{TL} SELECT id, slot, CAST(change_date AS VARCHAR) AS change_date, change_indicator FROM tl WHERE change_indicator IN ('A', 'D', 'M') AND change_date >= {DAY} - INTERVAL 12 MONTH")
def recent_changes(spark, d):
    return text_dates(timeline.recent_changes(view(spark, d, match=False), AS_OF).select("id", "slot", "change_date", "change_indicator"))


@query("good_matches", f"{TL} SELECT id, slot, match_type FROM tl WHERE confidence >= 0.7 AND match_type IN ('Name+Number', 'Number')")
def good_matches(spark, d):
    return timeline.good_matches(view(spark, d)).select("id", "slot", "match_type")


@query("current_simplified", f"""{TL} SELECT title_number, region, postcode, dataset_type, price_paid, CAST(max(file_month) AS VARCHAR) AS latest_file_month, count(DISTINCT proprietor_name) AS current_owner_count, string_agg(DISTINCT proprietor_name, '; ' ORDER BY proprietor_name) AS current_owners,
 string_agg(DISTINCT ch_company_name || ' (' || coalesce(matched_number, 'no number') || ')', '; ' ORDER BY ch_company_name || ' (' || coalesce(matched_number, 'no number') || ')') AS matched_companies, CAST(max(confidence) AS DOUBLE) AS best_match_confidence FROM tl WHERE {NOW} GROUP BY 1, 2, 3, 4, 5""")
def current_simplified(spark, d):
    rows = matched_by_title(spark, d, ("matched_number", "confidence", "ch_company_name"))
    return text_dates(timeline.current_simplified(timeline.timeline(rows, "corrected", AS_OF)))


@query("company_portfolio", f"""{TL} SELECT ch_company_name, matched_number AS company_number, ch_company_status AS company_status, count(DISTINCT CASE WHEN {NOW} THEN title_number END) AS current_properties, count(DISTINCT CASE WHEN ownership_status = 'Historical' THEN title_number END) AS historical_properties,
 count(DISTINCT title_number) AS total_properties_ever_owned, nullif(string_agg(DISTINCT CASE WHEN {NOW} THEN region END, ', ' ORDER BY CASE WHEN {NOW} THEN region END), '') AS current_regions, CAST(sum(CASE WHEN {NOW} THEN price_paid ELSE 0 END) AS BIGINT) AS total_current_value,
 CAST(min(date_proprietor_added) AS VARCHAR) AS earliest_ownership, CAST(max(CASE WHEN {NOW} THEN date_proprietor_added END) AS VARCHAR) AS latest_acquisition FROM tl WHERE ch_company_name IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT CASE WHEN {NOW} THEN title_number END) > 0""")
def company_portfolio(spark, d):
    return text_dates(timeline.company_portfolio(view(spark, d)))


@query("param_lookup", f"{TL} SELECT id, slot FROM tl WHERE title_number = 'T7' AND file_month = DATE '1998-05-01' OR title_number = 'T9' ORDER BY title_number, file_month DESC, slot, id LIMIT 1000")
def param_lookup(spark, d):
    history = view(spark, d, match=False)
    a = timeline.ownership_history(history, title="T7", file_month=dates_of("1998-05-01"))
    return a.unionByName(timeline.ownership_history(history, title="T9")).select("id", "slot")


def dates_of(text):
    from datetime import date

    return date.fromisoformat(text)


@query("status_share_of_total", f"{TL} SELECT ownership_status, count(*) AS records, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM tl GROUP BY 1")
def status_share(spark, d):
    return analytics.status_shares(view(spark, d, match=False))


@query("status_by_dataset", f"{TL} SELECT ownership_status, dataset_type, count(*) AS records FROM tl GROUP BY 1, 2")
def status_by_dataset(spark, d):
    return view(spark, d, match=False).groupBy("ownership_status", "dataset_type").agg(F.count("*").alias("records"))


@query("duplicate_owners_after_dedup", timeline_sql("deduplicated") + " SELECT title_number, proprietor_name, count(*) AS records FROM tl GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_owners(spark, d):
    return analytics.duplicates(view(spark, d, "deduplicated", False), ["title_number", "proprietor_name"])


@query("pick_test_companies", f"""{TL} SELECT proprietor_name, count(DISTINCT title_number) AS titles, count(DISTINCT file_month) AS snapshots, count(DISTINCT CASE WHEN ownership_status = 'Historical' THEN title_number END) AS sold FROM tl GROUP BY 1
 HAVING count(DISTINCT title_number) >= 5 AND count(DISTINCT file_month) > 1 AND count(DISTINCT CASE WHEN ownership_status = 'Historical' THEN title_number END) > 0 ORDER BY titles DESC, proprietor_name LIMIT 20""")
def pick_test(spark, d):
    # Nothing of a match is asked for.
    return analytics.pick_test_companies(timeline.timeline(slots.unpivot(titles(spark, d)), "corrected", AS_OF))


@query("company_properties", f"""{TL}, n AS (SELECT *, coalesce(matched_number, company_reg_no) AS company_number, coalesce(ch_company_name, proprietor_name) AS company_name FROM tl) SELECT company_number, company_name, count(DISTINCT title_number) AS property_count, string_agg(DISTINCT title_number, ', ' ORDER BY title_number) AS title_numbers,
 CAST(sum(price_paid) AS BIGINT) AS total_price_paid, CAST(min(date_proprietor_added) AS VARCHAR) AS earliest_acquisition, CAST(max(date_proprietor_added) AS VARCHAR) AS latest_acquisition FROM n WHERE company_number IS NOT NULL GROUP BY 1, 2""")
def company_properties(spark, d):
    return text_dates(analytics.company_properties(view(spark, d)))


@query("company_titles", f"""{TL}, n AS (SELECT *, coalesce(matched_number, company_reg_no) AS company_number, coalesce(ch_company_name, proprietor_name) AS company_name FROM tl) SELECT company_number, company_name, title_number,
 CAST(sum(price_paid) AS BIGINT) AS total_price_paid, CAST(min(date_proprietor_added) AS VARCHAR) AS earliest_acquisition, CAST(max(date_proprietor_added) AS VARCHAR) AS latest_acquisition FROM n WHERE company_number IS NOT NULL GROUP BY 1, 2, 3""")
def company_titles(spark, d):
    return text_dates(analytics.company_titles(view(spark, d)))


@query("wide_companies", f"""{MATCHED}, w AS (SELECT id, {", ".join(f"max(CASE WHEN slot = {i} THEN matched_name END) AS n{i}, max(CASE WHEN slot = {i} THEN matched_number END) AS m{i}, max(CASE WHEN slot = {i} THEN confidence END) AS c{i}" for i in range(1, 5))} FROM matched GROUP BY id)
SELECT t.id, {", ".join(f"coalesce(k{i}.company_name, n{i}) AS ch_company_name_{i}" for i in range(1, 5))}, CAST({" + ".join(f"coalesce(c{i}, 0)" for i in range(1, 5))} AS DOUBLE) AS total_match_confidence,
 CAST({" + ".join(f"CASE WHEN proprietor_{i}_name <> '' THEN 1 ELSE 0 END" for i in range(1, 5))} AS INTEGER) AS total_proprietor_count
FROM titles t LEFT JOIN w USING (id) {" ".join(f"LEFT JOIN companies k{i} ON m{i} = k{i}.company_number" for i in range(1, 5))}""")
def wide_companies(spark, d):
    return timeline.wide_companies(titles(spark, d), companies(spark, d)).withColumn("total_match_confidence", F.col("total_match_confidence").cast("double"))


INTERVALS = f"""WITH {SQL_TITLES}, newest AS (SELECT max(file_month) AS newest FROM titles), last AS (SELECT title_number, max(file_month) AS last_month FROM titles GROUP BY 1),
raw AS (SELECT t.*, coalesce(date_proprietor_added, min(file_month) OVER (PARTITION BY title_number, proprietor_1_name, coalesce(proprietor_2_name, ''), coalesce(proprietor_3_name, ''), coalesce(proprietor_4_name, ''))) AS start,
 CASE WHEN date_proprietor_added IS NOT NULL THEN 'DATED_' || CAST(date_proprietor_added AS VARCHAR) ELSE 'FIRST_APPEAR_' || proprietor_1_name || '_' || coalesce(proprietor_2_name, '') || '_' || coalesce(proprietor_3_name, '') || '_' || coalesce(proprietor_4_name, '') END AS dedup_key
 FROM titles t WHERE proprietor_1_name <> ''),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title_number, dedup_key ORDER BY file_month DESC, id DESC) AS rn FROM raw) WHERE rn = 1),
seq AS (SELECT *, lead(start) OVER w AS next_start, lead(price_paid) OVER w AS next_price, {", ".join(f"lag(proprietor_{i}_name) OVER w AS seller_{i}, lead(proprietor_{i}_name) OVER w AS next_{i}" for i in range(1, 5))} FROM one WINDOW w AS (PARTITION BY title_number ORDER BY start, file_month, dedup_key)),
iv AS (SELECT title_number, start AS ownership_start_date, coalesce(next_start, CASE WHEN gone THEN newest END) AS ownership_end_date, {", ".join(f"proprietor_{i}_name AS owner_{i}, seller_{i}" for i in range(1, 5))},
 CASE WHEN next_start IS NOT NULL AND next_1 IS NULL THEN 'PRIVATE SALE' WHEN next_start IS NOT NULL AND next_1 = proprietor_1_name THEN NULL WHEN next_start IS NULL AND gone THEN 'PRIVATE SALE' ELSE next_1 END AS buyer_1, next_2 AS buyer_2, next_3 AS buyer_3, next_4 AS buyer_4,
 price_paid AS price_at_acquisition, CASE WHEN next_start IS NOT NULL THEN next_price END AS price_at_disposal, CASE WHEN next_start IS NOT NULL OR gone THEN 'Previous' ELSE 'Current' END AS ownership_status,
 CAST(coalesce(next_start, CASE WHEN gone THEN newest END, {DAY}) - start AS INTEGER) AS ownership_duration_days, CASE dataset_type WHEN 'OCOD' THEN 'OVERSEAS COMPANY' WHEN 'CCOD' THEN 'UK COMPANY' ELSE 'OTHER' END AS ownership_type,
 CASE WHEN next_start IS NULL AND gone THEN 1 ELSE 0 END AS inferred_disposal_flag, CASE WHEN gone THEN 1 ELSE 0 END AS disposal_from_company
 FROM (SELECT seq.*, newest, last_month < newest AS gone FROM seq JOIN last USING (title_number), newest))"""


@query("ownership_intervals", f"{INTERVALS} SELECT * REPLACE (CAST(ownership_start_date AS VARCHAR) AS ownership_start_date, CAST(ownership_end_date AS VARCHAR) AS ownership_end_date) FROM iv")
def ownership_intervals(spark, d):
    return text_dates(intervals.ownership_intervals(titles(spark, d), AS_OF))


@query("dq_union_report", f"""{INTERVALS} SELECT 'Previous without end date' AS issue, count(*) FILTER (ownership_status = 'Previous' AND ownership_end_date IS NULL) AS records FROM iv UNION ALL SELECT 'Missing start date', count(*) FILTER (ownership_start_date IS NULL) FROM iv
 UNION ALL SELECT 'Negative duration', count(*) FILTER (ownership_duration_days < 0) FROM iv UNION ALL SELECT 'Current with end date', count(*) FILTER (ownership_status = 'Current' AND ownership_end_date IS NOT NULL) FROM iv""")
def dq_report(spark, d):
    return analytics.interval_checks(intervals.ownership_intervals(titles(spark, d), AS_OF))


@query("property_price_bands", f"""{BASE} SELECT id, title_number, split_part(postcode, ' ', 1) AS postcode_area, CAST(year(change_date) AS INTEGER) AS change_year, CAST(month(change_date) AS INTEGER) AS change_month, strftime(change_date, '%Y-%m') AS year_month,
 CASE WHEN price_paid IS NULL THEN '0. No Price' WHEN price_paid < 250000 THEN '1. Under £250k' WHEN price_paid < 500000 THEN '2. £250k-£500k' WHEN price_paid < 1000000 THEN '3. £500k-£1m' WHEN price_paid < 5000000 THEN '4. £1m-£5m' ELSE '5. Over £5m' END AS price_band,
 CASE WHEN multiple_address_indicator = 'Y' THEN 'Multiple' ELSE 'Single' END AS address_type FROM titles""")
def price_bands(spark, d):
    return analytics.property_summary(titles(spark, d))


@query("monthly_stats", f"""{BASE} SELECT dataset_type, CAST(file_month AS VARCHAR) AS file_month, strftime(file_month, '%Y-%m') AS year_month, CAST(year(file_month) AS INTEGER) AS year, CAST(month(file_month) AS INTEGER) AS month, count(*) AS property_count, count(price_paid) AS properties_with_price,
 round(avg(price_paid), 0) AS avg_price, CAST(sum(price_paid) AS BIGINT) AS total_value, count(DISTINCT district) AS unique_districts, count(DISTINCT split_part(postcode, ' ', 1)) AS unique_postcode_areas FROM titles GROUP BY dataset_type, titles.file_month""")
def monthly_stats(spark, d):
    return text_dates(analytics.monthly_stats(titles(spark, d)))


@query("geographic_stats", f"""{BASE} SELECT dataset_type, region, county, district, count(*) AS property_count, count(price_paid) AS properties_with_price, round(avg(price_paid), 0) AS avg_price, min(price_paid) AS min_price, max(price_paid) AS max_price, count(DISTINCT postcode) AS unique_postcodes, count(DISTINCT title_number) AS unique_properties
 FROM titles WHERE region <> '' AND county <> '' GROUP BY 1, 2, 3, 4""")
def geographic_stats(spark, d):
    return analytics.geographic_stats(titles(spark, d))


_BAND = "CASE WHEN property_count = 1 THEN '1. Single Property' WHEN property_count <= 5 THEN '2. 2-5 Properties' WHEN property_count <= 10 THEN '3. 6-10 Properties' WHEN property_count <= 50 THEN '4. 11-50 Properties' WHEN property_count <= 100 THEN '5. 51-100 Properties' ELSE '6. Over 100 Properties' END"


@query("company_size_bands", f"""{BASE}, s AS (SELECT company_reg_no, max(proprietor_name) AS company_name, max(category) AS category, max(country_incorporated) AS country, count(DISTINCT title_number) AS property_count, CAST(sum(DISTINCT price_paid) AS BIGINT) AS total_value_owned,
 CAST(min(date_proprietor_added) AS VARCHAR) AS first_seen_date, CAST(max(date_proprietor_added) AS VARCHAR) AS last_seen_date FROM long WHERE company_reg_no IS NOT NULL GROUP BY 1) SELECT *, CASE WHEN country IS NOT NULL THEN 'Overseas' ELSE 'UK' END AS company_type, {_BAND} AS portfolio_size FROM s""")
def company_size_bands(spark, d):
    return text_dates(analytics.company_stats(slots.unpivot(titles(spark, d))))


@query("price_trends_percentiles", f"""{BASE} SELECT dataset_type, region, CAST(year(change_date) AS INTEGER) AS year, count(*) AS transaction_count, round(avg(price_paid), 0) AS avg_price, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY price_paid), 0) AS median_price,
 round(percentile_cont(0.25) WITHIN GROUP (ORDER BY price_paid), 0) AS price_25th_percentile, round(percentile_cont(0.75) WITHIN GROUP (ORDER BY price_paid), 0) AS price_75th_percentile FROM titles WHERE price_paid > 0 AND region <> '' AND year(change_date) >= 1996 GROUP BY 1, 2, 3""")
def price_trends(spark, d):
    return analytics.price_trends(titles(spark, d), since=1996)


@query("recent_activity", f"""{BASE} SELECT dataset_type, CAST(change_date AS VARCHAR) AS change_date, change_indicator, count(*) AS property_count, count(price_paid) AS priced_properties, round(avg(price_paid), 0) AS avg_price, count(DISTINCT county) AS counties_affected, count(DISTINCT district) AS districts_affected
 FROM titles WHERE change_date >= {DAY} - INTERVAL 12 MONTH GROUP BY dataset_type, titles.change_date, change_indicator""")
def recent_activity(spark, d):
    return text_dates(analytics.recent_activity(titles(spark, d), AS_OF))


@query("snapshot_profile", f"{BASE} SELECT CAST(file_month AS VARCHAR) AS file_month, update_type, dataset_type, count(*) AS records, count(DISTINCT title_number) AS titles, count(*) FILTER (change_indicator = 'A') AS added, count(*) FILTER (change_indicator = 'D') AS deleted FROM titles GROUP BY titles.file_month, update_type, dataset_type")
def snapshot_profile(spark, d):
    return text_dates(analytics.snapshot_profile(titles(spark, d)))


@query("top_titles_per_region", f"{BASE} SELECT region, id, price_paid, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY price_paid DESC NULLS LAST, id) AS rn FROM titles) WHERE rn <= 10")
def top_titles(spark, d):
    return analytics.top_per_group(titles(spark, d), "region", [F.desc_nulls_last("price_paid"), F.col("id")]).select("region", "id", "price_paid", "rn")


@query("field_fill_profile", f"{BASE} SELECT 'region' AS \"column\", count(region) AS filled, CAST(max(length(region)) AS INTEGER) AS longest FROM titles UNION ALL SELECT 'price_paid', count(price_paid), CAST(max(length(CAST(price_paid AS VARCHAR))) AS INTEGER) FROM titles UNION ALL SELECT 'proprietor_3_name', count(proprietor_3_name), CAST(max(length(proprietor_3_name)) AS INTEGER) FROM titles")
def field_fill(spark, d):
    return analytics.filled(titles(spark, d), ["region", "price_paid", "proprietor_3_name"])


@query("whole_months", f"SELECT o_orderkey, CAST({MONTHS.format(e='CAST(o_orderdate AS DATE)', s='(DATE {q}1998-03-31{q} + CAST(o_orderkey % 97 AS INTEGER))').replace('{q}', chr(39))} AS INTEGER) AS months FROM orders")
def whole_months(spark, d):
    start = F.date_add(F.lit("1998-03-31").cast("date"), (F.col("o_orderkey") % 97).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", dates.whole_months(F.to_date("o_orderdate"), start).alias("months"))


@query("date_parts", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month, CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS year_quarter, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def date_parts(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", dates.year_month(day).alias("year_month"), dates.year_quarter(day).alias("year_quarter"), F.year(day).alias("year"), day.cast("string").alias("day"))
