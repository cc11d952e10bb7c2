"""Queries on stored views: built from the earlier months, refreshed with the later ones, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import refresh, slots, timeline
from ..operators.joins import without
from ..sources import tables
from ..sources.stored import Stored, shared_folder
from .matching import _SHOWN, SHOWN, shown
from .testdata import AS_OF, MATCHED, companies, titles
from .timelines import COLUMNS, NOW, TL, text_dates

#: What is stored first: titles up to this month, and a register in which every seventh company is still missing.
CUT = "1998-06-01"
SHOWN_TIMELINE = ["id", "slot", "title_number", "file_month", "proprietor_name", "matched_number", "ownership_status", "change_description", "match_quality", "ownership_sequence", "ownership_duration_months"]


def refreshed(spark, d, build, key=("title_number",)) -> Stored:
    """A view of titles, by build(titles, companies, deal), stored and then brought up to date. deal: rows are dealt by it as storing
    needs them. Views have the columns that are asked for."""
    before, now = titles(spark, d).where(F.col("file_month") <= F.lit(CUT).cast("date")), titles(spark, d)
    register = companies(spark, d)
    early = register.where(F.col("company_number").cast("int") % 7 != 0)
    store = Stored(spark, shared_folder(spark), key, split=8)
    store.write(build(before, early, store.dealt), dealt=True)
    with store.kept(refresh.changed_keys(before, now, ["title_number"])) as changed:
        # Titles that have changed anyway aren't asked for their companies.
        rest = without(now, changed, ["title_number"])
        changed = changed.union(refresh.titles_of_companies(rest, early, register))
        refresh.refresh(store, now, changed, lambda rows: build(rows, register, store.dealt), dealt=True)
    return store


def corrected(rows, register, deal=None, match=timeline.MATCHED):
    only = None if deal is None else ()
    return timeline.timeline(timeline.resolved_owners(rows, register, deal=deal, only=only, match=match), "corrected", AS_OF)


@query("stored_matches", f"{MATCHED} SELECT {_SHOWN} FROM matched")
def stored_matches(spark, d):
    build = lambda rows, register, deal: timeline.resolved_owners(rows, register, deal=deal, only=(), match=tuple(slots.MATCH)).select("title_number", *SHOWN, "confidence")
    return shown(refreshed(spark, d, build).read())


@query("stored_timeline", f"{TL} SELECT {COLUMNS} FROM tl")
def stored_timeline(spark, d):
    build = lambda rows, register, deal: corrected(rows, register, deal, ("matched_number", "match_type")).select(*SHOWN_TIMELINE)
    return text_dates(refreshed(spark, d, build).read())


@query("stored_current_ownership", f"{TL} SELECT title_number, count(*) AS owners, max(matched_number) AS last_company FROM tl WHERE {NOW} GROUP BY title_number")
def stored_current_ownership(spark, d):
    def build(rows, register, deal):
        now = timeline.current(corrected(rows, register, deal, ("matched_number",)))
        return now.groupBy("title_number").agg(F.count("*").alias("owners"), F.max("matched_number").alias("last_company"))

    return refreshed(spark, d, build).read()


@query("sql_lookup", f"{TL} SELECT id, slot, title_number, CAST(file_month AS VARCHAR) AS file_month, proprietor_name, ownership_status FROM tl WHERE title_number IN ('T5', 'T77') OR matched_number = '00000007'")
def sql_lookup(spark, d):
    """The timeline as a view, and its lookup as a table function, for clients that speak SQL."""
    tables.register_views({"ownership_timeline": text_dates(corrected(titles(spark, d), companies(spark, d)))})
    tables.register_lookup(spark, "ownership_timeline")
    shown_ = "id, slot, title_number, file_month, proprietor_name, ownership_status"
    return spark.sql(f"""SELECT {shown_} FROM ownership_history(company => '00000007') UNION ALL SELECT {shown_} FROM ownership_history(title => 'T5') WHERE NOT matched_number <=> '00000007'
 UNION ALL SELECT {shown_} FROM ownership_history('T77') WHERE NOT matched_number <=> '00000007'""")


@query("sql_view_report", f"{TL} SELECT ownership_status, match_type, count(*) AS owners, count(DISTINCT title_number) AS titles FROM tl GROUP BY ownership_status, match_type")
def sql_view_report(spark, d):
    tables.register_views({"ownership_timeline_all": corrected(titles(spark, d), companies(spark, d))})
    return spark.sql("SELECT ownership_status, match_type, count(*) AS owners, count(DISTINCT title_number) AS titles FROM ownership_timeline_all GROUP BY ownership_status, match_type")
