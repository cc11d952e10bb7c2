"""Ownership timelines: one row for each (title snapshot, owner), with status, sequence and duration.

The many historical definitions of the timeline differ in four choices, which are parameters here:

- status: "title_max" (of the title's newest month), "title_max_not_deleted", "global_max_not_deleted",
  "recency_rank" (the owner's newest row, not deleted), "date_based" (by the day the owner was added)
- dedup: "none", "per_slot_owner" (the newest row of a title's owner, slot by slot), "cross_slot_owner"
- scope: "all", "recent" (the newest months of all snapshots), "latest", "companies", "companies_all"
- as_of: today's date; nothing here reads the clock
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels
from ..functions.dates import whole_months
from ..functions.text import blank, present
from . import resolve
from .joins import spread
from .slots import MATCH, OWNER, SLOTS, unpivot


@dataclass(frozen=True)
class View:
    status: str = "recency_rank"
    dedup: str = "none"
    scope: str = "all"
    months: int = 3
    slots: tuple[int, ...] = (1, 2, 3, 4)
    change_style: str = "reference"
    null_end: bool = False  # a deletion without a date has no duration


#: The named definitions. The first are successive forms of the timeline, the others are built for reports.
VIEWS = {
    "original": View("title_max"),
    "comprehensive": View("title_max_not_deleted"),
    "corrected": View("recency_rank"),
    "latest_only": View("title_max_not_deleted", "per_slot_owner"),
    "deduplicated": View("title_max", "cross_slot_owner"),
    "complete": View("date_based", change_style="updated"),
    "normalized": View("global_max_not_deleted", change_style="short"),
    "limited": View("global_max_not_deleted", scope="recent", change_style="short"),
    "companies_only": View("global_max_not_deleted", scope="companies", change_style="short"),
    "all_companies": View("global_max_not_deleted", scope="companies_all", change_style="short"),
    "slot_one": View("global_max_not_deleted", slots=(1,), change_style="short"),
    "land_registry": View("global_max_not_deleted", change_style="short", null_end=True),
    "latest_month": View("global_max_not_deleted", scope="latest", slots=(1,), change_style="short"),
}


#: What a match brings to an owner's row.
MATCHED = (*MATCH, "ch_company_name", "ch_company_status")


def by_title(rows: DataFrame) -> DataFrame:
    return rows.repartition("title_number")


def not_deleted(c: Column) -> Column:
    return c.isNull() | (c != "D")


def newest_first(*keys: str, tie: str = "id") -> Window:
    return Window.partitionBy(*keys).orderBy(F.desc_nulls_last("file_month"), F.desc(tie))


def owners(titles: DataFrame, matches: DataFrame | None = None, companies: DataFrame | None = None) -> DataFrame:
    """Long owner rows with their match and company columns: one unpivot and one join for each table, whatever
    the number of slots. matches is wide (id, ch_*_1..4) or long (id, slot, ...)."""
    titles = _with_newest(titles)
    if matches is not None and "slot" not in matches.columns:
        return with_company(unpivot(titles.join(matches, "id", "left"), {**OWNER, **MATCH}), companies)
    long = unpivot(titles)
    if matches is not None:
        long = long.join(matches.select("id", "slot", *MATCH), ["id", "slot"], "left")
    return with_company(long, companies)


def resolved_owners(
    titles: DataFrame, companies: DataFrame, rules: resolve.Rules = resolve.PRODUCTION, deal: Callable[[DataFrame], DataFrame] | None = None,
    only: tuple[str, ...] | None = None, match: tuple[str, ...] = MATCHED,
) -> DataFrame:
    """owners() with matches made on the way: no join back to titles, and the register's columns fetched for the
    different owners only. deal: how rows are dealt by title; matches come to the titles then, and the result is dealt so. only: the
    owner's columns asked for, besides name and number, and match: those of the match; with deal no others are shuffled."""
    if deal is None:
        return resolve.resolve(unpivot(_with_newest(titles)), companies, rules, then=lambda found: with_company(found, companies))
    return _with_newest(_dealt(titles, companies, rules, deal, only, match)).where(present(F.col("proprietor_name")))


def _dealt(titles: DataFrame, companies: DataFrame, rules: resolve.Rules, deal: Callable[[DataFrame], DataFrame], only: tuple[str, ...] | None, match: tuple[str, ...]) -> DataFrame:
    """Owners' rows with their match, dealt by title, and a row without a name for titles that have no owner.

    Owners' names and numbers are shuffled with their title, and with nothing else of their rows, to the register's answers; titles, which
    have one row for all slots, and the answers are then dealt by title together, so that each answer is beside the rows that it is for."""
    titles, fields = _with_flags(titles, only)
    owner = ["proprietor_name", "company_reg_no", resolve.COMPANY]
    asked = unpivot(titles, {c: fields[c] for c in owner}).select("title_number", *owner)
    told = resolve.resolve(asked, companies, rules, then=lambda found: with_company(found, companies), keep=True)
    told = told.select("title_number", F.struct(*owner, *match).alias("_told"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in titles.schema if f.name != "title_number"]
    rows = deal(titles.withColumn("_told", F.lit(None).cast(told.schema["_told"].dataType)).unionByName(told.select("title_number", *nulls, "_told")))
    # An answer has no owner in any slot, and so one row, of the first.
    isa, long = F.col("_told").isNotNull(), unpivot(rows, fields, keep_one=True)
    long = long.withColumns({c: F.when(isa, F.col(f"_told.{c}")).otherwise(F.col(c)) for c in owner})
    same = Window.partitionBy("title_number", *owner)
    long = long.withColumns({c: F.first(f"_told.{c}", ignorenulls=True).over(same) for c in match})
    return long.where(~isa).drop("_told", resolve.COMPANY)


def _with_newest(titles: DataFrame) -> DataFrame:
    """title_max_month is over all rows of a title, owners or not: it comes before slots are dropped."""
    return titles.withColumn("title_max_month", F.max("file_month").over(Window.partitionBy("title_number")))


def with_company(long: DataFrame, companies: DataFrame | None) -> DataFrame:
    if companies is None or "matched_number" not in long.columns:
        return long
    ch = _one_each(companies, "company_name", "company_status").select(F.col("company_number").alias("_ch"), F.col("company_name").alias("ch_company_name"), F.col("company_status").alias("ch_company_status"))
    return long.withColumn("_number", spread(F.col("matched_number"), long)).join(ch, F.col("_number") == F.col("_ch"), "left").drop("_ch", "_number")


#: The name that it had before.
_with_company = with_company


def _one_each(companies: DataFrame, *columns: str) -> DataFrame:
    """One row of the register for each number, so that no join multiplies owners."""
    return companies.where(F.col("company_number").isNotNull()).groupBy("company_number").agg(F.min(F.struct(*columns)).alias("_c")).select("company_number", "_c.*")


def in_scope(long: DataFrame, view: View, as_of: date, of: DataFrame | None = None) -> DataFrame:
    """of: the same rows, from which the newest month is taken more cheaply."""
    if view.slots != (1, 2, 3, 4):
        long = long.where(F.col("slot").isin(*view.slots))
    if view.scope in ("recent", "latest", "companies"):
        every = long if of is None else of.where(F.col("slot").isin(*view.slots))
        newest = F.broadcast(every.agg(F.max("file_month").alias("_newest")))  # one row
        back = 0 if view.scope == "latest" else view.months
        long = long.join(newest, F.col("file_month") >= F.add_months("_newest", -back)).drop("_newest")
    kind = F.col("match_type") if "match_type" in long.columns else F.lit(None).cast("string")
    owned = F.col(resolve.COMPANY) if resolve.COMPANY in long.columns else F.col("category").isin(*labels.COMPANY_CATEGORIES)
    if view.scope == "companies":
        return long.where(owned & (kind != "Not_Company"))
    if view.scope == "companies_all":
        added = F.col("date_proprietor_added")
        return long.where(owned & (F.coalesce(kind, F.lit("")) != "Not_Company") & (added.isNull() | (added <= F.lit(as_of))))
    return long


def deduplicated(long: DataFrame, how: str) -> DataFrame:
    if how == "none":
        return long
    if how == "cross_slot_owner":
        # Later slots count only where every earlier one is filled with another name.
        earlier = F.col("_earlier")
        # A row is of one title: rows that are dealt by title stay where they are.
        names = F.collect_list(F.struct("slot", "proprietor_name")).over(Window.partitionBy("title_number", "id"))
        long = long.withColumn("_earlier", F.filter(names, lambda s: s["slot"] < F.col("slot")))
        long = long.where((F.size(earlier) == F.col("slot") - 1) & ~F.exists(earlier, lambda s: s["proprietor_name"] == F.col("proprietor_name"))).drop("_earlier")
        keys = ["title_number", "proprietor_name"]
    elif how == "per_slot_owner":
        keys = ["title_number", "proprietor_name", "slot"]
    else:
        raise ValueError(f"unknown dedup {how!r}")
    return long.withColumn("_rn", F.row_number().over(newest_first(*keys))).where("_rn = 1").drop("_rn")


def ranked(long: DataFrame, view: View, of: DataFrame | None = None) -> DataFrame:
    """The rows that stay, with ownership_sequence and what the rule of status compares. of: see in_scope.

    The window by title and owner comes first: its shuffle serves the one by slot too, and rows that are dealt by title aren't shuffled."""
    long = deduplicated(long, view.dedup)
    if view.dedup == "per_slot_owner":  # an owner has a row for each slot at most: their places in a short list need no further sort
        place = F.struct("file_month", "slot", "id")
        long = long.withColumn("_places", F.collect_list(place).over(Window.partitionBy("title_number", "proprietor_name")))
        long = long.withColumn("ownership_sequence", F.size(F.filter("_places", lambda p: p < place)) + 1).drop("_places")
    else:
        long = long.withColumn("ownership_sequence", F.row_number().over(Window.partitionBy("title_number", "proprietor_name").orderBy("file_month", "slot", "id")))
    if view.status == "recency_rank":
        return long.withColumn("_rank", F.row_number().over(newest_first("title_number", "slot", "proprietor_name")))
    if view.status == "global_max_not_deleted":
        every = long if of is None or view.dedup != "none" else of
        return long.join(F.broadcast(every.agg(F.max("file_month").alias("_newest"))))  # one row
    return long


#: ownership_status in words, by the mark of _state().
STATES = ("Historical", "Current")
DATED_STATES = ("Previous Owner", "Current Owner - Date Unknown", "Current Owner", "Future Owner")


def _state(rule: str, as_of: date) -> Column:
    """The place of a ranked() row's ownership_status in STATES, or by the rule "date_based" in DATED_STATES."""
    change, month = F.col("change_indicator"), F.col("file_month")
    if rule == "title_max":
        now = month == F.col("title_max_month")
    elif rule == "title_max_not_deleted":
        now = (month == F.col("title_max_month")) & not_deleted(change)
    elif rule == "global_max_not_deleted":
        now = (month == F.col("_newest")) & not_deleted(change)
    elif rule == "recency_rank":
        now = (F.col("_rank") == 1) & not_deleted(change)
    elif rule == "date_based":
        added = F.col("date_proprietor_added")
        return F.when(change == "D", 0).when(added.isNull(), 1).when(added <= F.lit(as_of), 2).otherwise(3)
    else:
        raise ValueError(f"unknown status {rule!r}")
    return F.when(now, 1).otherwise(0)


def _words(state: Column, rule: str) -> Column:
    first, *others = enumerate(DATED_STATES if rule == "date_based" else STATES)
    return reduce(lambda c, s: c.when(state == s[0], s[1]), others[:-1], F.when(state == first[0], first[1])).otherwise(others[-1][1])


def status(long: DataFrame, rule: str, as_of: date) -> DataFrame:
    """ownership_status of ranked() rows."""
    return long.withColumn("ownership_status", _words(_state(rule, as_of), rule)).drop("_newest", "_rank")


def timeline(long: DataFrame, view: View | str = "corrected", as_of: date = date(2025, 1, 1)) -> DataFrame:
    """The rows of owners() under one definition, with ownership_status, change_description, match_quality,
    ownership_sequence and ownership_duration_months."""
    view = VIEWS[view] if isinstance(view, str) else view
    return described(ranked(in_scope(long, view, as_of), view), view, as_of)


def resolved_timeline(titles: DataFrame, companies: DataFrame, view: View | str = "corrected", as_of: date = date(2025, 1, 1), rules: resolve.Rules = resolve.PRODUCTION, only: tuple[str, ...] | None = None, match: bool = True) -> DataFrame:
    """timeline(resolved_owners()) with the match last: titles are dealt by title while they have one row for all slots, every window
    runs where they are, and owners' rows are shuffled once, to fetch their match, with durations and not with what these are made of,
    and with short marks of which words are made afterwards. only: the owner's columns asked for, besides name and number; no others are
    shuffled. match: without it no match is made, its columns are missing, and the rows stay dealt by title."""
    view = VIEWS[view] if isinstance(view, str) else view
    titles, fields = _with_flags(titles, only)

    def scoped(long: DataFrame, of: DataFrame | None = None) -> DataFrame:
        # Scopes ask of a match only that it isn't Not_Company, which no company is, and, by "companies", that there is one.
        return in_scope(long.withColumn("match_type", F.when(~blank(F.col("proprietor_name")), "")), view, as_of, of).drop("match_type")

    every, dealt = scoped(unpivot(titles, fields)), titles.repartition("title_number")
    if view.status.startswith("title_max") and view.dedup != "cross_slot_owner" and view.scope == "all" and view.slots == (1, 2, 3, 4):
        # One sort of owners' rows serves all windows, that over the title too: titles without owners keep a row for it.
        order = ["file_month", "slot", "id"] if view.dedup == "none" else ["slot", F.desc_nulls_last("file_month"), F.desc("id")]
        sorted_ = unpivot(dealt, fields, keep_one=True).sortWithinPartitions("title_number", "proprietor_name", *order)
        rows = ranked(_with_newest(sorted_).where(present(F.col("proprietor_name"))), view, every)
    else:
        rows = ranked(scoped(unpivot(_with_newest(dealt), fields), unpivot(titles, fields)), view, every)
    if not match:
        return dated(rows, view, as_of).drop(resolve.COMPANY)
    marked = _lasting(rows, view, as_of).withColumn("_state", _state(view.status, as_of)).drop("_newest", "_rank")
    found = resolve.resolve(marked, companies, rules, then=lambda found: with_company(found, companies), of=every)
    found = found.withColumns({"ownership_status": _words(F.col("_state"), view.status), "change_description": labels.change_label(F.col("change_indicator"), view.change_style)})
    return found.drop("_state").withColumn("match_quality", labels.match_quality(F.col("match_type")))


def _with_flags(titles: DataFrame, only: tuple[str, ...] | None) -> tuple[DataFrame, dict[str, str]]:
    """titles with the answer to COMPANY of each slot, and the fields to unpivot."""
    fields = {c: p for c, p in OWNER.items() if only is None or c in only or c in ("proprietor_name", "company_reg_no")}
    fields[resolve.COMPANY] = "_company_{}"
    categories = {f"_company_{i}": OWNER["category"].format(i) for i in SLOTS}
    return titles.withColumns({new: resolve.is_company(F.col(old)) if old in titles.columns else F.lit(False) for new, old in categories.items()}), fields


def described(long: DataFrame, view: View, as_of: date) -> DataFrame:
    """ranked() rows with all columns of a timeline."""
    quality = labels.match_quality(F.col("match_type")) if "match_type" in long.columns else F.lit("No Match")
    return dated(long, view, as_of).withColumn("match_quality", quality)


def dated(long: DataFrame, view: View, as_of: date) -> DataFrame:
    """ranked() rows with the columns of a timeline that ask nothing of a match."""
    long = _lasting(status(long, view.status, as_of), view, as_of)
    return long.withColumn("change_description", labels.change_label(F.col("change_indicator"), view.change_style))


def _lasting(long: DataFrame, view: View, as_of: date) -> DataFrame:
    end, start = F.coalesce("change_date", F.lit(as_of)), F.coalesce("date_proprietor_added", "file_month")
    if view.status == "date_based":
        end, start = F.lit(as_of), F.col("date_proprietor_added")
    elif view.status == "global_max_not_deleted":
        ends = (F.col("change_indicator") == "D") & (F.lit(view.null_end) | F.col("change_date").isNotNull())
        end, start = F.when(ends, F.col("change_date")).otherwise(F.lit(as_of)), F.col("date_proprietor_added")
    return long.withColumn("ownership_duration_months", whole_months(end, start))


def ownership_history(history: DataFrame, title: str | None = None, company: str | None = None, postcode: str | None = None, file_month: date | None = None, limit: int | None = 1000) -> DataFrame:
    """Lookup by any of the given keys; a filter is added only for those, so that they reach the scan."""
    for column, value in (("title_number", title), ("matched_number", company), ("postcode", postcode), ("file_month", file_month)):
        if value is not None:
            history = history.where(F.col(column) == F.lit(value))
    history = history.orderBy("title_number", F.desc("file_month"), "slot", "id")
    return history if limit is None else history.limit(limit)


# --- reports over a timeline -----------------------------------------------------------------------------------


def listed(c: Column, sep: str = ", ") -> Column:
    """Distinct values in order, joined; null where there are none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), sep), F.lit(""))


def _n_of(c: Column) -> Column:
    """The number of distinct values, for groups of one title: several count_distinct would make a row of each row for each of them."""
    return F.size(F.collect_set(c)).cast("long")


def summary(t: DataFrame) -> DataFrame:
    """One row per title: owners, records, range of months, current owners, matches by confidence."""
    now = F.col("ownership_status") == "Current"
    bucket = labels.confidence_bucket(F.col("confidence"))
    return t.groupBy("title_number", "dataset_type").agg(
        _n_of(F.col("proprietor_name")).alias("total_unique_owners"),
        _n_of(F.col("file_month")).alias("ownership_records"),
        F.min("file_month").alias("earliest_record"),
        F.max("file_month").alias("latest_record"),
        listed(F.when(now, F.col("proprietor_name"))).alias("current_owners"),
        F.count_if(now).alias("current_owner_count"),
        F.count_if(bucket == "high").alias("high_confidence_matches"),
        F.count_if(bucket == "medium").alias("medium_confidence_matches"),
        F.count_if(bucket == "low").alias("low_confidence_matches"),
        F.count_if(bucket == "none").alias("no_matches"),
    )


def current(t: DataFrame) -> DataFrame:
    return t.where("ownership_status = 'Current'")


def latest_per_owner(t: DataFrame) -> DataFrame:
    return t.withColumn("_rn", F.row_number().over(Window.partitionBy("title_number", "proprietor_name").orderBy(F.desc("file_month"), F.desc("id"), "slot"))).where("_rn = 1").drop("_rn")


def recent_changes(t: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    return t.where(F.col("change_indicator").isin("A", "D", "M") & (F.col("change_date") >= F.add_months(F.lit(as_of), -months)))


def good_matches(t: DataFrame) -> DataFrame:
    return t.where((F.col("confidence") >= 0.7) & F.col("match_type").isin("Name+Number", "Number"))


def current_simplified(t: DataFrame) -> DataFrame:
    company = F.concat("ch_company_name", F.lit(" ("), F.coalesce("matched_number", F.lit("no number")), F.lit(")"))
    return current(t).groupBy("title_number", "region", "postcode", "dataset_type", "price_paid").agg(
        F.max("file_month").alias("latest_file_month"),
        _n_of(F.col("proprietor_name")).alias("current_owner_count"),
        listed(F.col("proprietor_name"), "; ").alias("current_owners"),
        listed(company, "; ").alias("matched_companies"),
        F.max("confidence").alias("best_match_confidence"),
    )


def company_portfolio(t: DataFrame) -> DataFrame:
    """Rows are dealt by company and title and sorted once: one row of each title counts it, so that all sums are by company and region,
    which are few, and regions are listed last. Distinct counts over the rows would make four of each."""
    now, company = F.col("ownership_status") == "Current", ["company_number", "ch_company_name", "company_status"]
    rows = t.where(F.col("ch_company_name").isNotNull()).select(
        "title_number", F.col("matched_number").alias("company_number"), "ch_company_name", F.col("ch_company_status").alias("company_status"),
        "region", "price_paid", "date_proprietor_added", now.alias("_now"), (F.col("ownership_status") == "Historical").alias("_before"),
    )
    title = Window.partitionBy("title_number", *company)
    once = (F.row_number().over(title.orderBy(F.desc("_now"))) == 1) & F.col("title_number").isNotNull()
    flagged = rows.withColumns({"_once": once, "_ever": F.max("_before").over(title)})
    by_region = flagged.groupBy(*company, "region").agg(
        F.max("_now").alias("_now"),
        F.count_if(F.col("_once") & F.col("_now")).alias("_current"),
        F.count_if(F.col("_once") & F.col("_ever")).alias("_historical"),
        F.count_if("_once").alias("_titles"),
        F.sum(F.when(F.col("_now"), F.col("price_paid")).otherwise(0)).alias("_value"),
        F.min("date_proprietor_added").alias("_first"),
        F.max(F.when(F.col("_now"), F.col("date_proprietor_added"))).alias("_last"),
    )
    out = by_region.groupBy("ch_company_name", "company_number", "company_status").agg(
        F.sum("_current").alias("current_properties"),
        F.sum("_historical").alias("historical_properties"),
        F.sum("_titles").alias("total_properties_ever_owned"),
        listed(F.when(F.col("_now"), F.col("region"))).alias("current_regions"),
        F.sum("_value").alias("total_current_value"),
        F.min("_first").alias("earliest_ownership"),
        F.max("_last").alias("latest_acquisition"),
    )
    return out.where("current_properties > 0")


def wide(titles: DataFrame, matches: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per title row with the four matched companies side by side: four joins on the register, unless the matches bring
    ch_company_name_1 to 4."""
    out, companies = titles.join(matches, "id", "left"), _one_each(companies, "company_name")
    for i in range(1, 5):
        if f"ch_company_name_{i}" in matches.columns:
            out = out.withColumn(f"ch_company_name_{i}", F.coalesce(f"ch_company_name_{i}", f"ch_matched_name_{i}"))
            continue
        ch = companies.select(F.col("company_number").alias(f"_n{i}"), F.col("company_name").alias(f"_c{i}"))
        out = out.withColumn("_key", spread(F.col(f"ch_matched_number_{i}"), titles)).join(ch, F.col("_key") == F.col(f"_n{i}"), "left").withColumn(f"ch_company_name_{i}", F.coalesce(f"_c{i}", f"ch_matched_name_{i}")).drop("_key", f"_n{i}", f"_c{i}")
    confidence = sum((F.coalesce(f"ch_match_confidence_{i}", F.lit(0).cast("decimal(3,2)")) for i in range(1, 5)), F.lit(0).cast("decimal(3,2)"))
    filled = sum((present(F.col(f"proprietor_{i}_name")).cast("int") for i in range(1, 5)), F.lit(0))
    return out.withColumns({"total_match_confidence": confidence.cast("decimal(4,2)"), "total_proprietor_count": filled})


def wide_companies(titles: DataFrame, companies: DataFrame, rules: resolve.Rules = resolve.PRODUCTION) -> DataFrame:
    """id, ch_company_name_1 to 4, total_match_confidence and total_proprietor_count of each title row, as wide() has them. Owners are
    shuffled to their match with their id alone, and what they found then by id. Titles themselves aren't shuffled: the first owner's row, or
    the one without a name that stays of a title row without owners, brings the number of owners."""
    titles, fields = _with_flags(titles, ())
    names = {i: present(F.col(OWNER["proprietor_name"].format(i))) for i in SLOTS}
    filled, first = sum((n.cast("int") for n in names.values()), F.lit(0)), F.coalesce(*[F.when(n, i) for i, n in names.items()], F.lit(1))
    slotted = [p.format(i) for p in fields.values() for i in SLOTS if p.format(i) in titles.columns]
    long = unpivot(titles.select("id", filled.alias("_filled"), first.alias("_first"), *slotted), fields, keep_one=True)
    long = long.withColumn("_filled", F.when(F.col("slot") == F.col("_first"), F.coalesce("_filled", F.lit(0)))).drop("_first")
    found = resolve.resolve(long, companies, rules, then=lambda found: with_company(found, companies), of=unpivot(titles, fields))
    # A name that is the company's isn't shuffled twice; a title row without an id has no matches.
    known, other = F.col("ch_company_name"), F.when(~F.col("matched_name").eqNullSafe(F.col("ch_company_name")), F.col("matched_name"))
    found = found.select("id", "slot", "_filled", *[F.when(F.col("id").isNotNull(), c).alias(n) for n, c in {"matched_number": F.col("matched_number"), "_known": known, "_other": other, "confidence": F.col("confidence")}.items()])
    of = lambda i, c: F.max(F.when(F.col("slot") == i, c))
    none = F.lit(0).cast("decimal(3,2)")
    rows = found.repartition("id").groupBy("id").agg(
        F.collect_list("_filled").alias("_filled"),
        *[F.coalesce(of(i, F.struct("matched_number", "_known"))["_known"], of(i, F.coalesce("_other", "_known"))).alias(f"ch_company_name_{i}") for i in SLOTS],
        sum((F.coalesce(of(i, F.col("confidence")), none) for i in SLOTS), none).cast("decimal(4,2)").alias("total_match_confidence"),
    )
    return rows.withColumn("total_proprietor_count", F.explode("_filled")).drop("_filled")
