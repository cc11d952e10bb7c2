"""Queries on what is kept up to date: the import ledger, company statistics, times of change."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..catalog import query, table
from ..operators import company_state, ledger, slots, upsert
from .tables import _ORDER, _SIDES, KEY, parts
from .testdata import AS_OF, BASE, companies, titles
from .timelines import _BAND, text_dates

_FILE = "concat('F', cast(user_id as string), '_', cast(event_id % 40 as string))"
_STATUS = "case event_type when 'purchase' then 'completed' when 'error' then 'failed' else 'running' end"
_RUN = "lpad(cast(event_id as string), 12, '0')"
_EVENTS = f"e AS (SELECT {_FILE} AS source_filename, {_STATUS} AS status, ts AS tm, {_RUN} AS run, event_id % 1000 AS rows, event_id % 7 AS errors FROM events)"
_FOLD = """f AS (SELECT *, row_number() OVER (PARTITION BY source_filename ORDER BY CASE WHEN status = 'completed' THEN 0 ELSE 1 END, tm, run) AS done, row_number() OVER (PARTITION BY source_filename ORDER BY tm DESC, status <> 'running' DESC, run DESC) AS last FROM e),
s AS (SELECT source_filename, count(*) FILTER (status = 'running') AS attempts, min(tm) FILTER (status = 'running') AS started_at, count(*) FILTER (status = 'completed') AS ends, max(tm) AS heard FROM e GROUP BY 1),
r AS (SELECT s.*, w.status AS state, w.tm, w.run, w.rows, w.errors FROM s JOIN f w ON w.source_filename = s.source_filename AND CASE WHEN ends > 0 THEN done = 1 ELSE last = 1 END)"""
NOW = datetime(2024, 1, 20)


def events(spark, d):
    e = table(spark, d, "events")
    return e.select(F.expr(_FILE).alias("source_filename"), F.expr(_STATUS).alias("status"), F.col("ts").alias("at"), F.expr(_RUN).alias("run"), (F.col("event_id") % 1000).alias("rows"), (F.col("event_id") % 7).alias("errors"))


@query("import_ledger", f"""WITH {_EVENTS}, {_FOLD} SELECT source_filename, state, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(CASE WHEN state <> 'running' THEN tm END, '%Y-%m-%d %H:%M:%S.%f') AS ended_at, attempts, run,
 CASE WHEN state = 'completed' THEN rows ELSE 0 END AS rows, CASE WHEN state = 'running' THEN 0 ELSE errors END AS errors, CASE WHEN state = 'completed' THEN ends - 1 ELSE 0 END AS completed_again FROM r""")
def import_ledger(spark, d):
    out = ledger.fold(events(spark, d))
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("started_at", "ended_at")})


@query("files_to_import", f"""WITH all_e AS (SELECT * FROM (WITH {_EVENTS} SELECT * FROM e)), e AS (SELECT * FROM all_e WHERE tm < TIMESTAMP '2024-01-20'), {_FOLD}, files AS (SELECT DISTINCT source_filename FROM all_e)
SELECT source_filename, why FROM (SELECT files.source_filename, CASE WHEN state IS NULL THEN 'new' WHEN state = 'failed' AND attempts < 2 THEN 'failed' WHEN state = 'running' AND heard < TIMESTAMP '2024-01-19' AND attempts < 2 THEN 'abandoned' END AS why
 FROM files LEFT JOIN r USING (source_filename)) WHERE why IS NOT NULL""")
def files_to_import(spark, d):
    log = events(spark, d)
    return ledger.to_import(log.select("source_filename").distinct(), log.where(F.col("at") < F.lit(NOW)), NOW, stale_minutes=24 * 60, attempts=2)


_STATS = f"""s AS (SELECT company_reg_no, max(proprietor_name) AS company_name, max(category) AS category, max(country_incorporated) AS country, count(DISTINCT title_number) AS property_count, CAST(sum(DISTINCT price_paid) AS BIGINT) AS total_value_owned,
 CAST(min(date_proprietor_added) AS VARCHAR) AS first_seen_date, CAST(max(date_proprietor_added) AS VARCHAR) AS last_seen_date FROM long WHERE company_reg_no IS NOT NULL GROUP BY 1)"""


@query("company_stats_maintained", f"{BASE}, {_STATS} SELECT *, CASE WHEN country IS NOT NULL THEN 'Overseas' ELSE 'UK' END AS company_type, {_BAND} AS portfolio_size FROM s")
def company_stats_maintained(spark, d):
    """What was counted to 1996, with a month whose prices were wrong; then that month is replaced and the later ones come."""
    long, month = slots.unpivot(titles(spark, d)), F.col("file_month")
    replaced = month == F.lit("1995-03-01").cast("date")
    early = month < F.lit("1997-01-01").cast("date")
    wrong = long.where(replaced).withColumns({"price_paid": F.col("price_paid") + 7, "title_number": F.concat("title_number", F.lit("x"))})
    held = company_state.merge(company_state.state(long.where(early & ~replaced)), company_state.state(wrong))
    held = company_state.advance(held, long.where(~early | replaced), wrong)
    return text_dates(company_state.statistics(held))


def _counted(where: str) -> str:
    key = "lpad(regexp_replace(company_reg_no, '^RS', ''), 8, '0')"
    return f"(SELECT {key} AS company_number, count(DISTINCT title_number) AS property_count, CAST(sum(DISTINCT price_paid) AS BIGINT) AS total_value FROM long WHERE company_reg_no IS NOT NULL AND {where} GROUP BY 1)"


_SIDE = "SELECT c.company_number, coalesce(property_count, 0) AS property_count, coalesce(total_value, 0) AS total_value FROM companies c LEFT JOIN {0} n USING (company_number)"


@query("companies_with_stats", f"""{BASE}, a AS ({_SIDE.format(_counted("file_month < DATE '1998-11-01'"))}), b AS ({_SIDE.format(_counted("true"))})
SELECT b.*, CASE WHEN a.property_count = b.property_count AND a.total_value = b.total_value THEN '1998-11-01' ELSE '{AS_OF.isoformat()}' END AS updated_at FROM a JOIN b USING (company_number)""")
def companies_with_stats(spark, d):
    """Statistics written into the register: only companies that a month changed get a new time."""
    long = slots.unpivot(titles(spark, d)).where("company_reg_no is not null").withColumn("company_reg_no", F.lpad(F.regexp_replace("company_reg_no", "^RS", ""), 8, "0"))
    early = F.col("file_month") < F.lit("1998-11-01").cast("date")
    held = company_state.state(long.where(early))

    def sides(state):
        stats = company_state.statistics(state).select(F.col("company_reg_no").alias("company_number"), "property_count", F.col("total_value_owned").alias("total_value"))
        whole = companies(spark, d).select("company_number").join(stats, "company_number", "left")
        return whole.select("company_number", F.coalesce("property_count", F.lit(0)).alias("property_count"), F.coalesce("total_value", F.lit(0)).alias("total_value"))

    register = sides(held).withColumn("updated_at", F.lit("1998-11-01").cast("date"))
    now = sides(company_state.advance(held, long.where(~early)))
    return text_dates(upsert.upsert_stamped(register, now, ["company_number"], ["property_count"], AS_OF))


@query("upsert_updated_at", f"""{_SIDES}, came AS (SELECT id, title_number, file_month, price_paid, region FROM new UNION ALL SELECT id, title_number, file_month, price_paid, CASE WHEN id LIKE '%1' THEN upper(region) ELSE region END FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.title_number = o.title_number AND n.file_month = o.file_month))
SELECT coalesce(c.id, o.id) AS id, title_number, CAST(file_month AS VARCHAR) AS file_month, CASE WHEN c.id IS NULL THEN o.region ELSE c.region END AS region, CASE WHEN c.id IS NULL OR (o.id = c.id AND o.price_paid IS NOT DISTINCT FROM c.price_paid AND o.region IS NOT DISTINCT FROM c.region) THEN '1999-01-01' ELSE '{AS_OF.isoformat()}' END AS updated_at
FROM old o FULL JOIN came c USING (title_number, file_month)""")
def upsert_updated_at(spark, d):
    old, new = parts(spark, d)
    kept = ["id", *KEY, "price_paid", "region"]
    again = old.withColumn("region", F.when(F.col("id").endswith("1"), F.upper("region")).otherwise(F.col("region"))).join(new.select(*KEY).distinct(), KEY, "left_anti")
    stored = old.select(*kept).withColumn("updated_at", F.lit("1999-01-01").cast("date"))
    came = upsert.last_row(new, KEY, _ORDER).select(*kept).unionByName(again.select(*kept))
    return text_dates(upsert.upsert_stamped(stored, came, KEY, ["id"], AS_OF).select("id", *KEY, "region", "updated_at"))
