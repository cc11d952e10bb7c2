"""Write-semantics, join, set, scalar, JSON, HTML and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import dates, html, labels, text
from ..operators import analytics, slots, upsert
from ..sources import psc
from ..sources.stored import shared_folder
from ..streaming import ingest
from .testdata import AS_OF, BASE, companies, titles
from .timelines import DAY, text_dates

KEY = ["title_number", "file_month"]
NEW = "update_type = 'FULL'"


def parts(spark, d):
    """The change-only rows as the table, the full rows as what comes in."""
    t = titles(spark, d).select("id", *KEY, "price_paid", "region", "source_filename", "update_type")
    return upsert.last_row(t.where("update_type = 'COU'"), KEY, ["source_filename", "id"]), t.where(NEW)


_SIDES = f"""{BASE}, t AS (SELECT id, title_number, file_month, price_paid, region, source_filename, update_type FROM titles),
old AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_number, file_month ORDER BY source_filename DESC, id DESC) AS rn FROM t WHERE update_type = 'COU') WHERE rn = 1),
new AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_number, file_month ORDER BY source_filename DESC, id DESC) AS rn FROM t WHERE {NEW}) WHERE rn = 1)"""
_ORDER = ["source_filename", "id"]


@query("upsert_last_writer", f"{_SIDES} SELECT id, title_number, CAST(file_month AS VARCHAR) AS file_month FROM new UNION ALL SELECT id, title_number, CAST(file_month AS VARCHAR) FROM old ANTI JOIN new USING (title_number, file_month)")
def upsert_last_writer(spark, d):
    old, new = parts(spark, d)
    return text_dates(upsert.upsert(old, new, KEY, _ORDER).select("id", *KEY))


@query("upsert_flags", f"{_SIDES} SELECT n.id, o.id IS NULL AS inserted FROM new n LEFT JOIN old o USING (title_number, file_month)")
def upsert_flags(spark, d):
    old, new = parts(spark, d)
    return upsert.upsert_flagged(old, new, KEY, _ORDER).select("id", "inserted")


@query("upsert_returning", f"{_SIDES} SELECT n.id, title_number, CAST(file_month AS VARCHAR) AS file_month, coalesce(n.price_paid, o.price_paid) AS price_paid, o.id IS NULL AS inserted FROM new n LEFT JOIN old o USING (title_number, file_month)")
def upsert_returning(spark, d):
    old, new = parts(spark, d)
    return text_dates(upsert.upsert_returning(old, new, KEY, _ORDER, ["price_paid"]).select("id", *KEY, "price_paid", "inserted"))


@query("events_by_day", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def events_by_day(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").cast("string").alias("day"), "event_type").agg(F.count("*").alias("events"))


@query("upsert_fill_nulls", f"""{_SIDES} SELECT title_number, CAST(file_month AS VARCHAR) AS file_month, coalesce(n.price_paid, o.price_paid) AS price_paid, coalesce(nullif(n.region, ''), o.region) AS region,
 CASE WHEN n.id IS NULL THEN o.source_filename WHEN o.id IS NULL THEN n.source_filename WHEN o.source_filename = 'basic_file' THEN 'basic_file+overview_scrape' WHEN o.source_filename LIKE '%scrape%' THEN o.source_filename ELSE n.source_filename END AS source_filename FROM old o FULL JOIN new n USING (title_number, file_month)""")
def upsert_fill(spark, d):
    old, new = parts(spark, d)
    return text_dates(upsert.upsert_filling(old, new, KEY, _ORDER, {"source_filename": upsert.lineage}).select(*KEY, "price_paid", "region", "source_filename"))


@query("upsert_null_keys", "SELECT o_orderstatus, o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) AS rn FROM (SELECT o_orderkey, nullif(o_custkey % 50, 0) AS o_custkey, o_orderstatus FROM orders)) WHERE rn = 1 OR o_custkey IS NULL")
def upsert_null_keys(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("o_custkey"), "o_orderstatus")
    return upsert.last_row(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"], null_keys_repeat=True)


@query("insert_not_exists", f"{_SIDES} SELECT id FROM old UNION ALL SELECT id FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.title_number = n.title_number AND o.file_month = n.file_month)")
def insert_not_exists(spark, d):
    old, new = parts(spark, d)
    return upsert.insert_new(old, upsert.last_row(new, KEY, _ORDER), KEY).select("id")


@query("update_from", f"{_SIDES} SELECT o.id, CASE WHEN n.id IS NOT NULL THEN coalesce(n.price_paid, o.price_paid) ELSE o.price_paid END AS price_paid FROM old o LEFT JOIN new n USING (title_number, file_month)")
def update_from(spark, d):
    old, new = parts(spark, d)
    return upsert.update_from(old, upsert.last_row(new, KEY, _ORDER), KEY, ["price_paid"]).select("id", "price_paid")


@query("delete_then_insert", f"{_SIDES} SELECT id FROM old WHERE title_number NOT IN (SELECT title_number FROM new) UNION ALL SELECT id FROM t WHERE {NEW}")
def delete_then_insert(spark, d):
    old, new = parts(spark, d)
    return upsert.delete_then_insert(old, new, "title_number").select("id")


@query("backfill_changes", f"{BASE} SELECT id, CASE WHEN update_type = 'FULL' AND coalesce(change_indicator, '') = '' THEN 'A' ELSE change_indicator END AS change_indicator, CAST(CASE WHEN update_type = 'FULL' AND coalesce(change_indicator, '') = '' THEN coalesce(change_date, date_proprietor_added) ELSE change_date END AS VARCHAR) AS change_date FROM titles")
def backfill(spark, d):
    return text_dates(upsert.backfill_changes(titles(spark, d)).select("id", "change_indicator", "change_date"))


@query("drop_deletes", f"{BASE} SELECT id FROM titles WHERE NOT (update_type = 'COU' AND coalesce(change_indicator, '') = 'D')")
def drop_deletes(spark, d):
    return upsert.drop_deletes(titles(spark, d)).select("id")


@query("dissolve_companies", f"{BASE} SELECT company_number, CAST(CASE WHEN company_status = 'Dissolved' THEN {DAY} END AS VARCHAR) AS dissolution_date FROM companies")
def dissolve(spark, d):
    return text_dates(upsert.dissolve(companies(spark, d).withColumn("dissolution_date", F.lit(None).cast("date")), AS_OF).select("company_number", "dissolution_date"))


@query("distinct_on_latest", f"{BASE} SELECT DISTINCT ON (title_number) title_number, id, CAST(file_month AS VARCHAR) AS file_month FROM titles ORDER BY title_number, titles.file_month DESC, id DESC")
def distinct_on_latest(spark, d):
    return text_dates(upsert.last_row(titles(spark, d), ["title_number"], ["file_month", "id"]).select("title_number", "id", "file_month"))


@query("split_properties", f"{BASE} SELECT id, slot, proprietor_name, region FROM long JOIN titles USING (id, region)")
def split_properties(spark, d):
    from ..sources.titles import split_titles

    properties, owners = split_titles(titles(spark, d))
    return properties.select("id", "region").join(owners.select("id", "slot", "proprietor_name"), "id")


@query("semi_exists", f"{BASE} SELECT id FROM titles t WHERE EXISTS (SELECT 1 FROM companies c WHERE c.company_status = 'Active' AND CAST(CAST(c.company_number AS BIGINT) AS VARCHAR) = t.company_1_reg_no)")
def semi_exists(spark, d):
    active = companies(spark, d).where("company_status = 'Active'").select(F.col("company_number").cast("long").cast("string").alias("company_1_reg_no"))
    return titles(spark, d).join(active, "company_1_reg_no", "left_semi").select("id")


@query("anti_missing", f"{BASE} SELECT company_number FROM companies c WHERE NOT EXISTS (SELECT 1 FROM titles t WHERE t.company_2_reg_no = CAST(CAST(c.company_number AS BIGINT) AS VARCHAR))")
def anti_missing(spark, d):
    used = titles(spark, d).select(F.lpad("company_2_reg_no", 8, "0").alias("company_number"))
    return analytics.missing(companies(spark, d), used, ["company_number"]).select("company_number")


@query("array_member_join", f"{BASE} SELECT DISTINCT l.proprietor_name, p.company_number FROM long l JOIN previous p ON l.proprietor_name = replace(p.old, ' Co', ' PLC')")
def array_member_join(spark, d):
    # x = ANY(array) as rows of an equi-join
    old = companies(spark, d).select("company_number", F.explode("previous_names").alias("old"))
    names = slots.unpivot(titles(spark, d)).select("proprietor_name").distinct()
    return names.join(old.select("company_number", F.replace("old", F.lit(" Co"), F.lit(" PLC")).alias("proprietor_name")), "proprietor_name")


@query("union_distinct_names", f"{BASE} SELECT proprietor_1_name AS name FROM titles WHERE proprietor_1_name <> '' UNION SELECT proprietor_2_name FROM titles WHERE proprietor_2_name <> '' UNION SELECT proprietor_3_name FROM titles WHERE proprietor_3_name <> '' UNION SELECT proprietor_4_name FROM titles WHERE proprietor_4_name <> ''")
def union_distinct(spark, d):
    return slots.unpivot(titles(spark, d)).select(F.col("proprietor_name").alias("name")).distinct()


@query("latest_snapshot_rows", f"{BASE} SELECT id FROM titles WHERE file_month = (SELECT max(file_month) FROM titles)")
def latest_snapshot(spark, d):
    t = titles(spark, d)
    return t.join(F.broadcast(t.agg(F.max("file_month").alias("file_month"))), "file_month").select("id")


@query("limited_semi", f"{BASE} SELECT id FROM titles WHERE title_number IN (SELECT title_number FROM titles GROUP BY 1 ORDER BY count(*) DESC, title_number LIMIT 5)")
def limited_semi(spark, d):
    t = titles(spark, d)
    top = t.groupBy("title_number").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title_number").limit(5)
    return t.join(top, "title_number", "left_semi").select("id")


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("json_keys", "SELECT key, count(*) AS records FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1")
def json_keys(spark, d):
    return table(spark, d, "events").select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count("*").alias("records"))


@query("json_top_values", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS records FROM events GROUP BY 1 ORDER BY records DESC, k LIMIT 10")
def json_top(spark, d):
    return table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("records")).orderBy(F.desc("records"), "k").limit(10)


def _psc_lines(spark, d):
    """Supplier rows as JSON lines, with bad, blank and numberless ones."""
    s = table(spark, d, "supplier")
    kind = F.when(F.col("s_suppkey") % 3 == 0, "individual-person-with-significant-control").when(F.col("s_suppkey") % 3 == 1, "corporate-entity-person").otherwise("super-secure-person")
    data = F.struct(
        kind.alias("kind"), F.col("s_name").alias("name"), F.struct(F.col("s_name").alias("surname")).alias("name_elements"), F.struct((F.col("s_suppkey") % 50 + 1940).alias("year"), (F.col("s_suppkey") % 12 + 1).alias("month")).alias("date_of_birth"),
        F.concat(F.lit("Country "), F.col("s_nationkey").cast("string")).alias("country_of_residence"), F.array(F.lit("ownership-of-shares"), F.lit("voting")).alias("natures_of_control"),
        F.concat(F.lit("20"), F.lpad((F.col("s_suppkey") % 20).cast("string"), 2, "0"), F.lit("-03-09")).alias("notified_on"), F.when(F.col("s_suppkey") % 4 == 0, "2021-01-02T10:11:12Z").alias("ceased_on"), F.col("s_suppkey").cast("string").alias("etag"),
    )
    line = F.to_json(F.struct(F.when(F.col("s_suppkey") % 7 != 0, F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("company_number"), data.alias("data")))
    return s.select(F.when(F.col("s_suppkey") % 11 == 0, "{broken").when(F.col("s_suppkey") % 13 == 0, "  ").otherwise(line).alias("value"))


_PSC = "FROM supplier WHERE s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0 AND s_suppkey % 7 <> 0"


@query("psc_flatten", f"""SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number, CASE s_suppkey % 3 WHEN 0 THEN 'individual' WHEN 1 THEN 'corporate-entity' ELSE 'other' END AS psc_kind, s_name AS name, s_name AS name_surname, CAST(s_suppkey % 50 + 1940 AS INTEGER) AS birth_year, CAST(s_suppkey % 12 + 1 AS INTEGER) AS birth_month,
 'Country ' || s_nationkey AS country_of_residence, '20' || lpad(CAST(s_suppkey % 20 AS VARCHAR), 2, '0') || '-03-09' AS notified_on, CASE WHEN s_suppkey % 4 = 0 THEN '2021-01-02' END AS ceased_on {_PSC}""")
def psc_flatten(spark, d):
    flat = psc.flatten(psc.parse_lines(_psc_lines(spark, d))[0])
    return text_dates(flat.select("company_number", "psc_kind", "name", "name_surname", "birth_year", "birth_month", "country_of_residence", "notified_on", "ceased_on"))


@query("psc_bad_lines", "SELECT count(*) AS records FROM supplier WHERE s_suppkey % 11 = 0")
def psc_bad(spark, d):
    return psc.parse_lines(_psc_lines(spark, d))[1].agg(F.count("*").alias("records"))


@query("psc_active_per_company", f"SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number, count(*) AS active_psc {_PSC} AND s_suppkey % 4 <> 0 GROUP BY 1")
def psc_active(spark, d):
    return psc.active_per_company(psc.flatten(psc.parse_lines(_psc_lines(spark, d))[0]))


@query("psc_top_countries", f"SELECT 'Country ' || s_nationkey AS country_of_residence, count(*) AS records {_PSC} GROUP BY 1 ORDER BY records DESC, country_of_residence LIMIT 10")
def psc_top(spark, d):
    return psc.top_countries(psc.flatten(psc.parse_lines(_psc_lines(spark, d))[0]))


@query("psc_of_active_companies", f"{BASE}, p AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number, s_name AS name {_PSC}) SELECT company_number, name, company_name FROM p JOIN companies USING (company_number) WHERE company_status = 'Active'")
def psc_companies(spark, d):
    return psc.of_active_companies(psc.flatten(psc.parse_lines(_psc_lines(spark, d))[0]), companies(spark, d)).select("company_number", "name", "company_name")


@query("clean_text", r"SELECT doc_id, nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS tidy, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') END AS tidy_none FROM documents")
def clean_text(spark, d):
    none = F.when(F.col("doc_id") % 9 == 0, " None ").otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", text.clean(F.col("text")).alias("tidy"), text.clean_none(none).alias("tidy_none"))


@query("date_formats", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot, CAST(CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS scraped, CAST(CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS iso FROM orders""")
def date_formats(spark, d):
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    f = lambda p: F.date_format(day, p)
    snap = F.when(k % 2 == 0, f("dd-MM-yyyy")).otherwise(F.concat(F.lit(" "), f("yyyy-MM-dd")))
    scraped = F.when(k % 5 == 0, f("d MMMM yyyy")).when(k % 5 == 1, f("d MMM yyyy")).when(k % 5 == 2, f("dd/MM/yyyy")).when(k % 5 == 3, f("dd-MM-yyyy")).otherwise("31 Smarch 1999")
    iso = F.when(k % 3 == 0, f("yyyy-MM-dd")).when(k % 3 == 1, F.concat(f("yyyy-MM-dd"), F.lit("T01:02:03Z"))).otherwise("yesterday")
    return text_dates(table(spark, d, "orders").select("o_orderkey", dates.snapshot_date(snap).alias("snapshot"), dates.scraped_date(scraped).alias("scraped"), dates.iso_date(iso).alias("iso")))


@query("list_fields", "SELECT p_partkey, list_aggregate([lpad(CAST(p_partkey % 99999 AS VARCHAR), 5, '0'), '12345'], 'string_agg', ',') AS sic, CASE WHEN p_name = p_brand THEN p_name ELSE p_name || ',' || p_brand END AS names FROM part")
def list_fields(spark, d):
    code = F.lpad((F.col("p_partkey") % 99999).cast("string"), 5, "0")
    sic = F.concat(code, F.lit(" - Growing of things; 12345 and 123456, 1234"))
    names = F.concat(F.lit(" | "), F.col("p_name"), F.lit("|"), F.col("p_brand"), F.lit(" |"), F.col("p_name"), F.lit("||"))
    return table(spark, d, "part").select("p_partkey", F.array_join(text.sic_codes(sic), ",").alias("sic"), F.array_join(text.split_list(names), ",").alias("names"))


@query("confidence_labels", """SELECT s_suppkey, CASE WHEN c >= 1.0 THEN 'Perfect Match - Company Number & Name' WHEN c >= 0.9 THEN 'High Confidence - Company Number Only' WHEN c >= 0.7 THEN 'Medium Confidence - Name Match' WHEN c >= 0.5 THEN 'Low Confidence - Previous Name' WHEN c >= 0.3 THEN 'Land Registry Data Only' ELSE 'No Match' END AS label,
 CASE WHEN c >= 0.9 THEN 'High' WHEN c >= 0.7 THEN 'Good' WHEN c >= 0.5 THEN 'Medium' WHEN c >= 0.3 THEN 'Poor' ELSE 'No Match' END AS grade FROM (SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 12 = 11 THEN NULL ELSE (s_suppkey % 12) / 10 END AS DECIMAL(3, 2)) AS c FROM supplier)""")
def confidence_labels(spark, d):
    c = F.when(F.col("s_suppkey") % 12 != 11, (F.col("s_suppkey") % 12) / 10).cast("decimal(3,2)")
    return table(spark, d, "supplier").select("s_suppkey", labels.confidence_label(c).alias("label"), labels.confidence_grade(c).alias("grade"))


@query("search_meta", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE lpad(CAST(s_suppkey AS VARCHAR), 8, '0') END AS number, CASE s_suppkey % 4 WHEN 0 THEN 'Private limited company' WHEN 1 THEN 'Company' END AS company_type,
 CASE s_suppkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'Dissolved on 12 January 2020' WHEN 2 THEN 'Open' END AS status FROM supplier""")
def search_meta(spark, d):
    n, k = F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.col("s_suppkey") % 4
    line = F.when(k == 0, F.concat(n, F.lit(" - Private limited company, Active"))).when(k == 1, F.concat(n, F.lit(" - Dissolved on 12 January 2020"))).when(k == 2, F.concat(n, F.lit(" - Open"))).otherwise("no separator")
    return table(spark, d, "supplier").select("s_suppkey", text.search_meta(line).alias("m")).select("s_suppkey", "m.*")


@query("url_hosts", r"SELECT regexp_extract(url, '://([^/:?#]+)', 1) AS host, count(*) AS pages FROM pages GROUP BY 1 HAVING count(*) > 1")
def url_hosts(spark, d):
    return table(spark, d, "pages").groupBy(F.regexp_extract("url", "://([^/:?#]+)", 1).alias("host")).agg(F.count("*").alias("pages")).where("pages > 1")


@query("html_page_facts", r"""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g')), '') AS title,
 CAST(len(regexp_extract_all(html, '<h[12][\s>]', 0, 'i')) AS INTEGER) AS headings, CAST(len(regexp_extract_all(html, '<a\s[^>]*href\s*=\s*["'']?[^"''>\s]', 0, 'i')) AS INTEGER) AS links FROM pages""")
def html_facts(spark, d):
    return table(spark, d, "pages").select("page_id", html.page_facts(F.col("html")).alias("f")).select("page_id", "f.title", F.size("f.headings").alias("headings"), F.size("f.links").alias("links"))


@query("arrival_windows", "SELECT CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS VARCHAR) AS start, event_type AS status, count(*) AS files, CAST(sum(event_id % 10) AS BIGINT) AS rows FROM events GROUP BY 1, 2")
def arrival_windows(spark, d):
    ledger = table(spark, d, "events").select(F.col("ts").alias("at"), F.col("event_type").alias("status"), (F.col("event_id") % 10).alias("rows"))
    out = ingest.progress(ledger)
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "status", "files", "rows")


@query("stream_upsert", f"{BASE} SELECT title_number, CAST(file_month AS VARCHAR) AS file_month, id FROM (SELECT *, row_number() OVER (PARTITION BY title_number, file_month ORDER BY source_filename DESC, id DESC) AS rn FROM titles) WHERE rn = 1")
def stream_upsert(spark, d):
    """The title rows through the streaming upsert, file by file, into a partitioned table that is read back."""
    out = shared_folder(spark)
    source = spark.readStream.schema(table(spark, d, "lineitem").schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    from .testdata import TITLES

    rows = source.select(*[F.expr(TITLES[c]).alias(c) for c in ("title_number", "file_month", "id", "source_filename")])
    writer = ingest.upsert_batch(f"{out}/table", KEY, _ORDER)
    rows.writeStream.foreachBatch(writer).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return text_dates(spark.read.parquet(f"{out}/table").select("title_number", "file_month", "id"))
