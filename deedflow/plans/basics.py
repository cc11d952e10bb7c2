"""Small relational queries: predicates, joins, aggregates, windows, sorts and set operations over the title model."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..catalog import query, table
from ..functions import labels, text
from ..operators import analytics, slots, timeline
from ..sources.titles import file_facts
from .matching import matched
from .testdata import AS_OF, BASE, MATCHED, companies, titles
from .timelines import DAY, text_dates


@query("filter_present", f"{BASE} SELECT id FROM titles WHERE region IS NOT NULL AND region <> '' AND price_paid BETWEEN 500000 AND 900000")
def filter_present(spark, d):
    return titles(spark, d).where(text.present(F.col("region")) & F.col("price_paid").between(500_000, 900_000)).select("id")


@query("filter_categories", f"{BASE} SELECT id, slot FROM long WHERE category IN ('Limited Company or Public Limited Company', 'Limited Liability Partnership')")
def filter_categories(spark, d):
    long = slots.unpivot(titles(spark, d))
    return long.where(labels.company_owner(F.col("proprietor_name"), F.col("category"))).select("id", "slot")


@query("filter_not_equal_nullable", f"{BASE} SELECT count(*) FILTER (change_indicator <> 'D') AS plain, count(*) FILTER (coalesce(change_indicator, '') <> 'D') AS null_safe FROM titles")
def not_equal(spark, d):
    c = F.col("change_indicator")
    return titles(spark, d).agg(F.count_if(c != "D").alias("plain"), F.count_if(F.coalesce(c, F.lit("")) != "D").alias("null_safe"))


@query("filter_patterns", f"{BASE} SELECT id, slot FROM long WHERE proprietor_name ILIKE 'supplier#%7 limited' AND NOT proprietor_name LIKE 'supplier%' OR regexp_matches(company_reg_no, '^RS[0-9]*5$')")
def filter_patterns(spark, d):
    name = F.col("proprietor_name")
    return slots.unpivot(titles(spark, d)).where((name.ilike("supplier#%7 limited") & ~name.like("supplier%")) | F.col("company_reg_no").rlike("^RS[0-9]*5$")).select("id", "slot")


@query("filter_dates", f"{BASE} SELECT id FROM titles WHERE (date_proprietor_added IS NULL OR date_proprietor_added <= {DAY} - INTERVAL 60 MONTH) AND file_month >= {DAY} - INTERVAL 12 MONTH")
def filter_dates(spark, d):
    added = F.col("date_proprietor_added")
    return titles(spark, d).where((added.isNull() | (added <= F.add_months(F.lit(AS_OF), -60))) & (F.col("file_month") >= F.add_months(F.lit(AS_OF), -12))).select("id")


@query("filter_array_member", f"{BASE} SELECT DISTINCT company_number FROM previous WHERE old = 'Former#000000004 Co'")
def array_member(spark, d):
    return companies(spark, d).where(F.array_contains("previous_names", "Former#000000004 Co")).select("company_number")


@query("join_by_expression", f"{BASE} SELECT l.id, l.slot, c.company_number FROM long l JOIN companies c ON upper(trim(l.proprietor_name)) = upper(trim(c.company_name))")
def join_expression(spark, d):
    key = lambda c: F.upper(text.strip(F.col(c)))
    long = slots.unpivot(titles(spark, d)).withColumn("_k", key("proprietor_name"))
    return long.join(companies(spark, d).select("company_number", key("company_name").alias("_k")), "_k").select("id", "slot", "company_number")


@query("join_composite_key", "SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderdate < l_shipdate WHERE l_linenumber = 2")
def join_composite(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem").where("l_linenumber = 2")
    return orders.join(lines, (orders.o_orderkey == lines.l_orderkey) & (orders.o_orderdate < lines.l_shipdate)).select("o_orderkey", "l_linenumber", "l_quantity")


@query("join_parent_child", f"{BASE} SELECT r_name AS region_name, count(*) AS owners, count(DISTINCT s_suppkey) AS companies FROM long JOIN supplier ON company_reg_no = CAST(s_suppkey AS VARCHAR) JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def join_parent_child(spark, d):
    long = slots.unpivot(titles(spark, d))
    suppliers, nations, regions = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    joined = long.join(suppliers, long.company_reg_no == suppliers.s_suppkey.cast("string")).join(nations, suppliers.s_nationkey == nations.n_nationkey).join(regions, nations.n_regionkey == regions.r_regionkey)
    return joined.groupBy(F.col("r_name").alias("region_name")).agg(F.count("*").alias("owners"), F.count_distinct("s_suppkey").alias("companies"))


@query("matches_beside_titles", f"{MATCHED} SELECT t.id, m.match_type, CAST(m.confidence AS DOUBLE) AS confidence FROM titles t LEFT JOIN matched m ON t.id = m.id AND m.slot = 1")
def matches_beside_titles(spark, d):
    first = matched(spark, d).where("slot = 1").select("id", "match_type", F.col("confidence").cast("double").alias("confidence"))
    return titles(spark, d).select("id").join(first, "id", "left")


@query("global_aggregate", f"{BASE} SELECT count(*) AS records, count(price_paid) AS priced, count(DISTINCT title_number) AS titles, count(DISTINCT CASE WHEN change_indicator = 'D' THEN title_number END) AS deleted_titles, CAST(sum(DISTINCT price_paid) AS BIGINT) AS distinct_value, min(postcode) AS first_postcode, max(postcode) AS last_postcode FROM titles")
def global_aggregate(spark, d):
    return titles(spark, d).agg(
        F.count("*").alias("records"), F.count("price_paid").alias("priced"), F.count_distinct("title_number").alias("titles"), F.count_distinct(F.when(F.col("change_indicator") == "D", F.col("title_number"))).alias("deleted_titles"),
        F.sum_distinct(F.col("price_paid")).alias("distinct_value"), F.min("postcode").alias("first_postcode"), F.max("postcode").alias("last_postcode"),
    )


@query("group_by_expression", f"{BASE} SELECT CAST(year(change_date) AS INTEGER) AS year, strftime(change_date, '%Y') || '-Q' || quarter(change_date) AS quarter, count(*) AS records FROM titles WHERE change_date IS NOT NULL GROUP BY 1, 2")
def group_by_expression(spark, d):
    from ..functions.dates import year_quarter

    return titles(spark, d).where("change_date is not null").groupBy(F.year("change_date").alias("year"), year_quarter(F.col("change_date")).alias("quarter")).agg(F.count("*").alias("records"))


@query("having_many_owners", f"{BASE} SELECT title_number, count(DISTINCT proprietor_name) AS owners FROM long GROUP BY 1 HAVING count(DISTINCT proprietor_name) > 40")
def having(spark, d):
    return slots.unpivot(titles(spark, d)).groupBy("title_number").agg(F.count_distinct("proprietor_name").alias("owners")).where("owners > 40")


@query("ratio_with_guard", f"{BASE} SELECT region, round(100.0::DOUBLE * count(*) FILTER (change_indicator = 'D') / nullif(count(*) FILTER (change_indicator = 'A' AND price_paid > 1900000), 0), 2) AS deleted_per_added FROM titles GROUP BY 1")
def ratio(spark, d):
    added = F.count_if((F.col("change_indicator") == "A") & (F.col("price_paid") > 1_900_000))
    return titles(spark, d).groupBy("region").agg(analytics.share(F.count_if(F.col("change_indicator") == "D"), added).alias("deleted_per_added"))


@query("ordered_lists", f"{BASE} SELECT title_number, string_agg(DISTINCT region, ', ' ORDER BY region) AS regions, string_agg(DISTINCT CASE WHEN price_paid > 1900000 THEN proprietor_name END, '; ' ORDER BY CASE WHEN price_paid > 1900000 THEN proprietor_name END) AS rich_owners FROM long WHERE region <> '' GROUP BY 1")
def ordered_lists(spark, d):
    rich = F.when(F.col("price_paid") > 1_900_000, F.col("proprietor_name"))
    return slots.unpivot(titles(spark, d)).where("region <> ''").groupBy("title_number").agg(timeline.listed(F.col("region")).alias("regions"), timeline.listed(rich, "; ").alias("rich_owners"))


@query("array_aggregate", f"{BASE} SELECT region, string_agg(id, ',' ORDER BY id) AS ids FROM titles WHERE price_paid > 2000000 GROUP BY 1")
def array_aggregate(spark, d):
    return titles(spark, d).where("price_paid > 2000000").groupBy("region").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"))


@query("neighbours", f"{BASE} SELECT id, lag(price_paid) OVER w AS before, lead(price_paid) OVER w AS after, CAST(row_number() OVER w AS INTEGER) AS place, max(file_month) OVER (PARTITION BY title_number) = file_month AS newest FROM titles WINDOW w AS (PARTITION BY title_number ORDER BY file_month, id)")
def neighbours(spark, d):
    w = Window.partitionBy("title_number").orderBy("file_month", "id")
    newest = F.max("file_month").over(Window.partitionBy("title_number")) == F.col("file_month")
    return titles(spark, d).select("id", F.lag("price_paid").over(w).alias("before"), F.lead("price_paid").over(w).alias("after"), F.row_number().over(w).alias("place"), newest.alias("newest"))


@query("top_prices", f"{BASE} SELECT id, price_paid FROM titles ORDER BY price_paid DESC NULLS LAST, id LIMIT 25")
def top_prices(spark, d):
    return titles(spark, d).select("id", "price_paid").orderBy(F.desc_nulls_last("price_paid"), "id").limit(25)


@query("seeded_sample", f"{BASE} SELECT id FROM titles WHERE md5(id || '-7') < '04'")
def seeded_sample(spark, d):
    """A random sample that a seed repeats: rows go by a hash and not by their place."""
    return titles(spark, d).where(F.md5(F.concat("id", F.lit("-7"))) < "04").select("id")


@query("scalar_subquery", f"{BASE} SELECT id FROM titles WHERE price_paid > (SELECT avg(price_paid) * 1.9 FROM titles)")
def scalar_subquery(spark, d):
    t = titles(spark, d)
    return t.join(F.broadcast(t.agg((F.avg("price_paid") * 1.9).alias("_limit"))), F.col("price_paid") > F.col("_limit")).select("id")


@query("labelled_union", f"{BASE} SELECT 'titles' AS source, count(*) AS records FROM titles UNION ALL SELECT 'owners', count(*) FROM long UNION ALL SELECT 'companies', count(*) FROM companies")
def labelled_union(spark, d):
    count = lambda df, name: df.agg(F.count("*").alias("records")).select(F.lit(name).alias("source"), "records")
    return analytics.union_all([count(titles(spark, d), "titles"), count(slots.unpivot(titles(spark, d)), "owners"), count(companies(spark, d), "companies")])


@query("typed_null_columns", f"{BASE} SELECT id, CAST(NULL AS VARCHAR) AS sic_code, CAST(NULL AS BIGINT) AS charges FROM titles")
def typed_nulls(spark, d):
    return titles(spark, d).select("id", F.lit(None).cast("string").alias("sic_code"), F.lit(None).cast("long").alias("charges"))


@query("formatted_numbers", f"{BASE} SELECT dataset_type, format('{{:,}}', CAST(sum(price_paid) AS BIGINT)) AS total FROM titles GROUP BY 1")
def formatted_numbers(spark, d):
    return titles(spark, d).groupBy("dataset_type").agg(F.format_number(F.sum("price_paid"), 0).alias("total"))


@query("file_names", f"{BASE} SELECT source_filename, split_part(source_filename, '_', 1) AS dataset_type, split_part(source_filename, '_', 2) AS update_type, substr(split_part(source_filename, '_', 3), 1, 7) || '-01' AS file_month, count(*) AS records FROM titles GROUP BY 1, 2, 3, 4")
def file_names(spark, d):
    name = F.replace("source_filename", F.lit("-"), F.lit("_"))
    facts = [c.alias(n) for n, c in file_facts(name).items()]
    return text_dates(titles(spark, d).select("source_filename", *facts).groupBy("source_filename", "dataset_type", "update_type", "file_month").agg(F.count("*").alias("records")))


@query("price_bands_count", f"{BASE} SELECT CASE WHEN price_paid IS NULL THEN '0. No Price' WHEN price_paid < 250000 THEN '1. Under £250k' WHEN price_paid < 500000 THEN '2. £250k-£500k' WHEN price_paid < 1000000 THEN '3. £500k-£1m' WHEN price_paid < 5000000 THEN '4. £1m-£5m' ELSE '5. Over £5m' END AS price_band, count(*) AS records FROM titles GROUP BY 1")
def price_bands_count(spark, d):
    return titles(spark, d).groupBy(labels.price_band(F.col("price_paid")).alias("price_band")).agg(F.count("*").alias("records"))


@query("new_names_to_queue", f"{MATCHED} SELECT DISTINCT upper(trim(proprietor_name)) AS search_name FROM matched WHERE match_type = 'Land_Registry' EXCEPT SELECT upper(trim(company_name)) FROM companies")
def new_names(spark, d):
    from ..operators.resolve import unmatched

    known = companies(spark, d).select(F.upper(text.strip(F.col("company_name"))).alias("search_name"))
    return unmatched(matched(spark, d)).select("search_name").join(known, "search_name", "left_anti")


@query("pending_queue", "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events WHERE event_type = (SELECT min(event_type) FROM events)) WHERE rn <= 100")
def pending_queue(spark, d):
    events = table(spark, d, "events")
    first = F.broadcast(events.agg(F.min("event_type").alias("event_type")))
    return events.join(first, "event_type", "left_semi").orderBy("ts", "event_id").limit(100).select("event_id")


@query("charges_report", "SELECT l_orderkey, l_linenumber, l_linestatus = 'O' AS outstanding FROM lineitem WHERE l_suppkey = 7 AND l_linenumber <> 3")
def charges_report(spark, d):
    lines = table(spark, d, "lineitem")
    charges = lines.select(
        F.col("l_suppkey").cast("string").alias("company_number"), F.when(F.col("l_linenumber") == 3, "page_9").otherwise(F.concat(F.lit("c"), F.col("l_orderkey").cast("string"))).alias("charge_id"),
        F.when(F.col("l_linestatus") == "O", "Outstanding").otherwise("Satisfied").alias("status"), F.to_date("l_shipdate").alias("created_date"), "l_orderkey", "l_linenumber",
    )
    return analytics.charges_report(charges, "7").select("l_orderkey", "l_linenumber", "outstanding")


@query("wide_by_slot_filters", f"{BASE} SELECT region, count(*) FILTER (proprietor_1_name <> '') AS first_owner, count(*) FILTER (proprietor_2_name <> '') AS second_owner, count(*) FILTER (proprietor_4_name <> '') AS fourth_owner FROM titles GROUP BY 1")
def wide_counts(spark, d):
    return titles(spark, d).groupBy("region").agg(*[F.count_if(text.present(F.col(f"proprietor_{i}_name"))).alias(n) for i, n in ((1, "first_owner"), (2, "second_owner"), (4, "fourth_owner"))])
