"""Queries that go through files: the tables are written as the reference's kinds of files and read back by their readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import dates, html, text
from ..sources import companies as register
from ..sources import psc, tables, titles
from ..sources.stored import shared_folder
from ..streaming import ingest
from .pages import compressed
from .tables import _ORDER, _PSC, _psc_lines
from .testdata import BASE, TITLES
from .timelines import text_dates

# --- snapshots ------------------------------------------------------------------------------------------------

_FILE = "concat(case when l_linestatus = 'F' then 'CCOD' else 'OCOD' end, case when l_linenumber % 2 = 0 then '_COU_' else '_FULL_' end, substr(cast(cast(l_shipdate as date) as string), 1, 4), '_', substr(cast(cast(l_shipdate as date) as string), 6, 2), '.csv')"
_PRICE = "case when l_suppkey % 5 = 0 then ' n/a' when l_suppkey % 5 = 1 then '' else concat(' ', cast(cast(floor(l_extendedprice) as bigint) as string), ' ') end"
_OWNER = "concat('  \"Quoted\",  ', case when l_linenumber % 3 = 0 then 'two' else 'one' end, '\n lines ', cast(l_suppkey as string))"
_ADDED = "case when l_linenumber % 4 = 0 then date_format(l_shipdate, 'dd-MM-yyyy') when l_linenumber % 4 = 1 then date_format(l_shipdate, 'yyyy-MM-dd') when l_linenumber % 4 = 2 then '31-02-2001' end"


def snapshot_rows(spark, d):
    """Raw rows as a snapshot's reader gets them, of files in a folder for each file name."""
    rows = table(spark, d, "lineitem").select(
        F.expr(_FILE).alias("source"), F.concat(F.lit(" T"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("Title Number "), F.lit(" Freehold ").alias(" Tenure"), F.expr(_PRICE).alias("Price Paid"),
        F.expr(_OWNER).alias("Proprietor Name (1)"), F.expr(_ADDED).alias("Date Proprietor Added"), F.expr(TITLES["change_indicator"]).alias("Change Indicator"), F.col("l_orderkey").cast("string").alias("Postcode"),
    )
    folder = shared_folder(spark)
    # Spaces are kept, as the files have them; a title's rows of one file go to one task.
    rows.repartition("source").write.partitionBy("source").option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return titles.read_csv(spark, folder)


_RAW = f"""raw AS (SELECT {_FILE.replace('string', 'varchar')} AS source_filename, 'T' || l_partkey AS title_number, 'Freehold' AS tenure, CASE WHEN l_suppkey % 5 > 1 THEN CAST(floor(l_extendedprice) AS BIGINT) END AS price_paid, '"Quoted", ' || CASE WHEN l_linenumber % 3 = 0 THEN 'two' ELSE 'one' END || ' lines ' || l_suppkey AS proprietor_1_name,
 CAST(CASE WHEN l_linenumber % 4 < 2 THEN CAST(l_shipdate AS DATE) END AS VARCHAR) AS date_proprietor_added, {TITLES['change_indicator']} AS change_indicator, CAST(l_orderkey AS VARCHAR) AS postcode, CASE WHEN l_linestatus = 'F' THEN 'CCOD' ELSE 'OCOD' END AS dataset_type,
 CASE WHEN l_linenumber % 2 = 0 THEN 'COU' ELSE 'FULL' END AS update_type, CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS file_month FROM lineitem),
kept AS (SELECT * FROM raw WHERE NOT (update_type = 'COU' AND coalesce(change_indicator, '') = 'D'))"""


@query("snapshot_files", f"WITH {_RAW} SELECT * FROM kept")
def snapshot_files(spark, d):
    parsed = titles.parse_titles(snapshot_rows(spark, d), F.col("source"))
    return text_dates(parsed.select("source_filename", "title_number", "tenure", "price_paid", "proprietor_1_name", "date_proprietor_added", "change_indicator", "postcode", "dataset_type", "update_type", "file_month"))


@query("import_files_once", f"""WITH {_RAW}, l AS (SELECT *, max(source_filename) OVER (PARTITION BY title_number, file_month, dataset_type) AS last_file, max(dataset_type) OVER (PARTITION BY title_number, file_month) AS last_set FROM kept)
SELECT title_number, file_month, source_filename, count(*) AS files FROM (SELECT DISTINCT title_number, file_month, source_filename FROM l WHERE dataset_type = last_set AND source_filename = last_file) GROUP BY ALL""")
def import_files_once(spark, d):
    """Two imports: what the ledger has of the first isn't read again by the second, which finds all files."""
    rows = titles.parse_titles(snapshot_rows(spark, d), F.col("source"))
    ledger = spark.createDataFrame([], "source_filename string, file_month date, rows long, status string")
    base = shared_folder(spark)
    first, ledger = titles.import_titles(rows.limit(0), ledger, rows.where("dataset_type = 'CCOD'"))
    tables.reload(first, f"{base}/table")
    tables.reload(ledger, f"{base}/ledger")
    again, _ = titles.import_titles(spark.read.parquet(f"{base}/table"), spark.read.parquet(f"{base}/ledger"), rows)
    return text_dates(again.groupBy("title_number", "file_month", "source_filename").agg(F.count("*").alias("files")))


# --- the register and what a search found ---------------------------------------------------------------------

_BORN = "cast('1985-01-01' as date) + cast(s_suppkey as int) * 20"


@query("register_files", f"""SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number, CASE WHEN s_suppkey % 9 > 0 THEN s_name END AS company_name, CAST({_BORN} AS VARCHAR) AS incorporation_date, CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_suppkey % 4 AS INTEGER) END AS mortgages_num_charges,
 CASE WHEN s_suppkey % 3 = 0 THEN 'OLD ' || s_name || '|OLDER' WHEN s_suppkey % 3 = 1 THEN 'OLDER' ELSE '' END AS previous_names FROM supplier WHERE s_suppkey % 8 > 0""")
def register_files(spark, d):
    """Two register files; the later by name is read."""
    s = table(spark, d, "supplier")
    n = F.col("s_suppkey")
    day = F.expr(_BORN)
    rows = s.select(
        F.when(n % 8 > 0, F.lpad(n.cast("string"), 8, "0")).otherwise("None").alias(" CompanyNumber"), F.when(n % 9 > 0, F.col("s_name")).otherwise(" none ").alias("CompanyName "), F.when(n % 2 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-M-d")).alias("IncorporationDate"),
        F.when(n % 4 > 0, (n % 4).cast("string")).otherwise("many").alias("Mortgages.NumMortCharges"), F.when(n % 3 == 0, F.concat(F.lit("OLD "), "s_name")).alias("PreviousName_1.CompanyName"), F.when(n % 3 < 2, F.lit(" OLDER")).alias("PreviousName_2.CompanyName"),
    )
    base = shared_folder(spark)
    paths = [f"{base}/BasicCompanyDataAsOneFile-2024-{m:02d}-01.csv" for m in (1, 2)]
    for path, part in zip(paths, (rows.limit(3), rows), strict=True):
        part.write.option("header", True).csv(path)
    out = register.read_companies(spark, register.latest_file(paths))
    return text_dates(out.select("company_number", "company_name", "incorporation_date", "mortgages_num_charges", F.array_join("previous_names", "|").alias("previous_names")))


@query("scraped_files", r"""SELECT s_name AS search_name, CASE WHEN s_suppkey % 6 = 0 THEN 'FOUND AGAIN' WHEN s_suppkey % 3 = 0 THEN 'ERROR' ELSE 'FOUND' END AS search_status, CASE WHEN s_suppkey % 6 = 0 THEN 'N' || s_suppkey WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS company_number,
 CASE WHEN s_suppkey % 3 > 0 OR s_suppkey % 6 = 0 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0') || ',62020' ELSE '' END AS sic_codes, CASE WHEN s_suppkey % 3 > 0 THEN 'AB' || (s_suppkey % 9) || ' 1XY' END AS postcode FROM supplier""")
def scraped_files(spark, d):
    """A file of search results, the file of the repeated searches in the other spelling of headers, and both merged."""
    s, n = table(spark, d, "supplier"), F.col("s_suppkey")
    sic = F.concat(F.lpad(n.cast("string"), 5, "0"), F.lit(" - x, 62020"))
    found = n % 3 > 0
    main = s.select(
        F.col("s_name").alias("Search Name"), F.when(found, "FOUND").otherwise("ERROR").alias(" Status"), F.when(found, n.cast("string")).alias("Company Number"), F.when(found, sic).alias("SIC Codes"),
        F.when(found, F.concat(F.lit("1 Some Road, Town, AB"), (n % 9).cast("string"), F.lit(" 1XY, England"))).alias("Registered Office Address"),
    )
    again = s.where(n % 6 == 0).select(F.concat(F.lit(" "), F.upper("s_name")).alias("Search Name"), F.lit("FOUND AGAIN").alias("Status"), F.concat(F.lit("N"), n.cast("string")).alias("Company Number"), sic.alias("SIC Codes"), F.lit(None).cast("string").alias("Registered Office Address"), F.lit("timeout").alias("Original Error"))
    base = shared_folder(spark)
    main.write.option("header", True).csv(f"{base}/main")
    again.write.option("header", True).csv(f"{base}/again")
    merged = register.merge_rescraped(titles.read_csv(spark, f"{base}/main"), titles.read_csv(spark, f"{base}/again"))
    lower = merged.toDF(*[c.lower().replace(" ", "_") for c in merged.columns])
    out = register.parse_scraped(lower)
    name = F.concat(F.lit("Supplier"), F.substring("search_name", 9, 100))  # repeated searches are in upper case
    return out.select(name.alias("search_name"), "search_status", "company_number", F.array_join("sic_codes", ",").alias("sic_codes"), text.find_postcode(F.col("reg_address_full")).alias("postcode"))


@query("psc_files", f"SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS company_number, CAST(s_suppkey AS VARCHAR) AS etag, name, 'persons-with-significant-control-snapshot-2.txt' AS source {_PSC.replace('FROM supplier', 'FROM (SELECT *, s_name AS name FROM supplier)')}")
def psc_files(spark, d):
    """Two snapshots of the same lines: rows of the later file replace those of the earlier, company by company and tag by tag."""
    base, lines = shared_folder(spark), _psc_lines(spark, d)
    names = [f"persons-with-significant-control-snapshot-{i}.txt" for i in (1, 2)]
    for n in names:
        lines.write.text(f"{base}/{n}")
    read = [psc.read_psc(spark, f"{base}/{n}").withColumn("source_filename", F.lit(n)) for n in names]
    merged = psc.import_psc(read[0].limit(0), read[0].unionByName(read[1]))
    return merged.select("company_number", "etag", "name", F.col("source_filename").alias("source"))


# --- helpers --------------------------------------------------------------------------------------------------


@query("date_helpers", """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 < 3 THEN day END AS VARCHAR) AS registered, CAST(CASE WHEN o_orderkey % 7 < 6 THEN day END AS VARCHAR) AS any_kind, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS INTEGER) END AS number,
 CASE o_orderkey % 3 WHEN 0 THEN '' ELSE 'a b' END AS plain FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)""")
def date_helpers(spark, d):
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    f = lambda p: F.date_format(day, p)
    registered = F.when(k % 4 == 0, f("dd/MM/yyyy")).when(k % 4 == 1, f("yyyy-M-d")).when(k % 4 == 2, f("d-M-yyyy")).otherwise("99/99/2000")
    every = F.when(k % 7 == 0, f("yyyyMMdd")).when(k % 7 == 1, f("d MMM yyyy")).when(k % 7 == 2, f("d/M/yyyy")).when(k % 7 == 3, f("yyyy-MM-dd")).when(k % 7 == 4, f("d MMMM yyyy")).when(k % 7 == 5, f("dd-MM-yyyy")).otherwise("20001332")
    number = F.when(k % 3 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).when(k % 3 == 1, "12a").otherwise("")
    plain = F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("\u0000 a\u0000 b ")).otherwise("a b")
    out = table(spark, d, "orders").select("o_orderkey", dates.register_date(registered).alias("registered"), dates.any_date(every).alias("any_kind"), text.strip(number).try_cast("int").alias("number"), text.strip_nul(plain).alias("plain"))
    return text_dates(out)


_OFFICER = """concat('<span id="officer-name-1">', s_name, '</span><span id="officer-status-tag-1">', CASE WHEN s_suppkey % 2 = 0 THEN 'Active' ELSE 'Resigned' END, '</span><dl><dt>Role <span>tag</span></dt><dd>Director</dd><dt>Date of birth</dt><dd>May ', cast(1940 + cast(s_suppkey % 50 as int) as string),
 '</dd><dt>Appointed on</dt><dd>1 May 2001</dd>', CASE WHEN s_suppkey % 3 = 0 THEN '<dt>Nationality</dt><dd>British</dd>' ELSE '' END, '<dt>Correspondence address</dt><dd>1 Road<br> Town</dd></dl>')"""


@query("officer_pages", """SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'Active' ELSE 'Resigned' END AS status, 'Director' AS role, '1 May 2001' AS appointed_on, '1 Road Town' AS address, CASE WHEN s_suppkey % 3 = 0 THEN 'British' END AS nationality, CAST(1940 + s_suppkey % 50 AS INTEGER) AS birth_year FROM supplier""")
def officer_pages(spark, d):
    page = table(spark, d, "supplier").select("s_suppkey", compressed(F.expr(_OFFICER)).alias("page"))
    return page.select("s_suppkey", html.officer_of(F.col("page")).alias("o")).select("s_suppkey", "o.name", "o.status", "o.role", "o.appointed_on", "o.address", "o.nationality", "o.birth_year")


# --- streams --------------------------------------------------------------------------------------------------

_TITLE = ("title_number", "file_month", "id", "source_filename")


@query("stream_resumed", f"{BASE} SELECT title_number, CAST(file_month AS VARCHAR) AS file_month, id FROM (SELECT *, row_number() OVER (PARTITION BY title_number, file_month ORDER BY source_filename DESC, id DESC) AS rn FROM titles) WHERE rn = 1")
def stream_resumed(spark, d):
    """Three runs of one stream over a folder that grows: each takes the new files only, as its checkpoint says, and a later file's rows
    of a month replace those of an earlier one."""
    base = shared_folder(spark)
    rows = table(spark, d, "lineitem").select(*[F.expr(TITLES[c]).alias(c) for c in _TITLE])
    # Earlier files first, as they would come: the order of names decides between rows of one title and month.
    parts = [F.col("source_filename") < "CCOD_FULL", F.col("source_filename").between("CCOD_FULL", "OCOD_COU_1996"), F.col("source_filename") > "OCOD_COU_1996"]
    for part in parts:
        rows.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        writer = stream.writeStream.foreachBatch(ingest.upsert_batch(f"{base}/table", ["title_number", "file_month"], _ORDER))
        writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return text_dates(spark.read.parquet(f"{base}/table").select("title_number", "file_month", "id"))


@query("stream_missing_matches", f"{BASE} SELECT id FROM titles WHERE id NOT IN (SELECT id FROM titles WHERE price_paid IS NULL)")
def stream_missing_matches(spark, d):
    """Titles that come as a stream, without those that have a match already."""
    base = shared_folder(spark)
    source = spark.readStream.schema(table(spark, d, "lineitem").schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    stream = source.select(F.expr(TITLES["id"]).alias("id"))
    matched = table(spark, d, "lineitem").select(F.expr(TITLES["id"]).alias("id"), F.expr(TITLES["price_paid"]).alias("price_paid")).where("price_paid is null")
    out = ingest.match_missing(stream, matched).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
    out.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id string").parquet(f"{base}/out")
