"""Results and plans whose size must not outgrow the input."""

import os
import re

import pytest
from pyspark.sql import functions as F

from deedflow.operators import resolve

FIELDS = "search_name string, company_number string, company_name string, company_status string, previous_names array<string>"


def found(spark):
    rows = [("A", "1", "A", "Active", ["B"]), ("A", "2", "X", "Dissolved", None), ("A", "2", "X", "Dissolved", None), (None, "3", "A", None, ["A", "B", None]), ("C", None, "C", "Active", [])]
    return spark.createDataFrame(rows, FIELDS)


def joined_rows(df, spark):
    """Rows that the largest join of an executed plan gave out."""
    df.collect()
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "Join" in text
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if "Join" in name:
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_candidate_report_counts_what_the_join_of_rows_would(spark):
    owners = [("T1", "A", None), ("T1", "A", None), ("T2", "A", None), ("T2", "B", None), (None, "B", None), ("T3", "C", None), ("T4", "A", "9"), ("T5", "Z", None), ("T6", None, None)]
    got = resolve.candidate_report(spark.createDataFrame(owners, "title_number string, proprietor_name string, company_reg_no string"), found(spark))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("exact_match", "Active", 3, 1, 3), ("search_name_match", "Dissolved", 2, 1, 2), ("exact_match", None, 2, 1, 2), ("previous_name_match", "Active", 2, 1, 1), ("previous_name_match", None, 2, 1, 1),
    ], key=str)


def test_candidate_report_does_not_multiply_titles_by_companies(spark):
    owners = spark.range(300).select(F.col("id").cast("string").alias("title_number"), F.lit("A").alias("proprietor_name"), F.lit(None).cast("string").alias("company_reg_no"))
    many = spark.range(200).select(F.lit("A").alias("search_name"), F.col("id").cast("string").alias("company_number"), F.lit("X").alias("company_name"), F.lit("Active").alias("company_status"), F.array().cast("array<string>").alias("previous_names"))
    report = resolve.candidate_report(owners, many)
    assert joined_rows(report, spark) <= 1000
    assert [tuple(r) for r in report.collect()] == [("search_name_match", "Active", 60000, 200, 300)]


SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def formatted(spark, name):
    from deedflow import catalog
    from deedflow.plans import load_all

    load_all()
    return spark._jvm.PythonSQLUtils.explainString(catalog.QUERIES[name](spark, SF)._jdf.queryExecution(), "formatted")


def wide_exchanges(spark, name, column):
    return sum(column in c for c in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", formatted(spark, name)))


@tables
@pytest.mark.parametrize("name", ["corrected", "original", "comprehensive", "latest_only", "deduplicated", "complete", "normalized", "land_registry", "all_companies"])
def test_owners_of_a_timeline_are_shuffled_once(spark, name):
    assert wide_exchanges(spark, f"timeline_{name}", "slot#") <= 1


@tables
@pytest.mark.parametrize("name", ["ownership_summary", "current_simplified", "company_portfolio"])
def test_reports_do_not_multiply_rows_for_distinct_counts(spark, name):
    assert "Expand" not in formatted(spark, name)


@tables
def test_test_companies_are_picked_without_matching(spark):
    assert "supplier.parquet" not in formatted(spark, "pick_test_companies")


def test_timeline_with_the_match_last_is_the_timeline_of_matched_owners(spark):
    from datetime import date

    from deedflow.operators import timeline

    company = "Limited Company or Public Limited Company"
    rows = [(str(i), t, date(2020, m, 1), "D" if i % 5 == 0 else None, None, date(2019 + i % 3, 5, i + 1), a, "1" if i % 2 else None, company if i % 4 else "Council", b, None, company) for i, (t, m, a, b) in enumerate([
        ("T1", 1, "A LTD", "B LTD"), ("T1", 2, "A LTD", "A LTD"), ("T1", 2, "", "A LTD"), ("T2", 1, " ", "C"), ("T2", 5, "C", " "), ("T3", 6, None, None), (None, 3, "A LTD", "C"), (None, 4, "A LTD", "A LTD"), ("T4", 6, "Z", "A LTD"),
    ])]
    wide = spark.createDataFrame(rows, "id string, title_number string, file_month date, change_indicator string, change_date date, date_proprietor_added date, proprietor_1_name string, company_1_reg_no string, proprietorship_1_category string, proprietor_2_name string, company_2_reg_no string, proprietorship_2_category string")
    register = spark.createDataFrame([("1", "A LIMITED", "Active", date(2000, 1, 1), ["C"]), ("2", "B LTD", "Active", date(2001, 1, 1), [])], "company_number string, company_name string, company_status string, incorporation_date date, previous_names array<string>")
    for name in timeline.VIEWS:
        want = timeline.timeline(timeline.resolved_owners(wide, register), name, date(2020, 12, 31))
        got = timeline.resolved_timeline(wide, register, name, date(2020, 12, 31))
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect())), name


@tables
@pytest.mark.parametrize("name", ["match_number_variants", "match_scraped", "cross_slot_distinct", "wide_companies"])
def test_owners_rows_are_shuffled_once(spark, name):
    text = formatted(spark, name)
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    if name == "wide_companies":  # no join by slot after the titles met their matches
        assert text.count("supplier.parquet") <= 4
    else:
        assert sum("slot#" in c for c in inputs) <= 1
    assert "LeftSemi" not in text


@tables
@pytest.mark.parametrize("name", ["not_in_corrected", "not_in_null_semantics"])
def test_counts_by_slot_match_counted_owners(spark, name):
    text = formatted(spark, name)
    assert not any("slot#" in c and "n#" not in c and "count#" not in c and "sum#" not in c for c in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text))


def test_rows_dealt_as_they_are_stored_are_not_shuffled_again(spark, tmp_path):
    from pyspark.sql.window import Window

    from deedflow.operators.joins import within, without
    from deedflow.sources.stored import Stored

    t = Stored(spark, f"file://{tmp_path}/t", ("k",), buckets=4, split=2)
    rows = spark.range(500).select((F.col("id") % 50).cast("string").alias("k"), "id")
    dealt = t.dealt(rows).withColumn("n", F.row_number().over(Window.partitionBy("k", "id").orderBy("id")))
    assert spark._jvm.PythonSQLUtils.explainString(dealt._jdf.queryExecution(), "simple").count("Exchange") == 1
    t.write(dealt, dealt=True)
    assert t.read().count() == 500
    files = [f for f in t.read().inputFiles()]
    assert len(files) <= 8  # a task has one bucket
    # almost all keys: the few others are broadcast, and stay
    keys = rows.select("k").distinct().where("k <> '7'")
    assert without(rows, keys, ["k"], most=10).select("k").distinct().collect() == [("7",)]
    assert within(rows, keys, ["k"], most=10).count() == 490
    assert "SortMergeJoin" not in spark._jvm.PythonSQLUtils.explainString(within(rows, keys, ["k"], most=10)._jdf.queryExecution(), "simple")
    t.replace(keys, t.dealt(dealt.where("k <> '7' and id < 100")), dealt=True)
    assert sorted(r.id for r in t.read().where("k = '7'").collect()) == list(range(7, 500, 50)) and t.read().count() == 10 + 98


def nodes(spark, name, kind):
    """The input columns of each node of that kind in a plan."""
    return re.findall(rf"\(\d+\) {kind}\nInput \[\d+\]: \[(.*)\]", formatted(spark, name))


@tables
@pytest.mark.parametrize("name", ["original", "comprehensive", "latest_only", "complete", "normalized", "land_registry"])
def test_owners_of_a_timeline_are_sorted_once(spark, name):
    assert sum("slot#" in c for c in nodes(spark, f"timeline_{name}", "Sort")) == 1
    assert not any("title_number#" in c and "slot#" not in c for c in nodes(spark, f"timeline_{name}", "Sort"))
    assert not any("country_" in c or "category" in c for c in nodes(spark, f"timeline_{name}", "Exchange"))


def test_owners_places_after_deduplication_are_in_order_of_month_slot_and_id(spark):
    from datetime import date

    from deedflow.operators import timeline

    rows = [("T", "A", s, m and date(2020, m, 1), i) for s, m, i in [(1, 5, "b"), (1, 4, "a"), (2, 5, "a"), (3, None, "c"), (4, 2, "d"), (4, None, "e")]] + [("T", "B", 2, date(2020, 1, 1), "a"), (None, "A", 1, None, "z")]
    long = spark.createDataFrame(rows, "title_number string, proprietor_name string, slot int, file_month date, id string")
    got = timeline.ranked(long, timeline.View("title_max", "per_slot_owner"))
    assert sorted((r.proprietor_name, r.id, r.slot, r.ownership_sequence) for r in got.collect()) == [("A", "a", 2, 4), ("A", "b", 1, 3), ("A", "c", 3, 1), ("A", "d", 4, 2), ("A", "z", 1, 1), ("B", "a", 2, 1)]


def portfolio_rows():
    from datetime import date
    from itertools import product

    out = []
    for i, (c, t, r, now) in enumerate(product([("A", "1", "Active"), ("A", None, None), ("B", "2", None), (None, "3", None)], ["T1", "T2", "T3", None], ["N", "", None, "S"], [True, False, True])):
        if (i * 7) % 5 < 3 and not (c[0] == "B" and now):
            out.append((*c, t, r, "Current" if now else "Historical", None if i % 4 == 0 else i, None if i % 6 == 0 else date(2020, 1 + i % 12, 1 + i % 28)))
    return out


def test_company_portfolio_counts_each_title_once(spark):
    from deedflow.operators import timeline

    rows = portfolio_rows()
    t = spark.createDataFrame(rows, "ch_company_name string, matched_number string, ch_company_status string, title_number string, region string, ownership_status string, price_paid long, date_proprietor_added date")
    want = []
    for key in {r[:3] for r in rows if r[0] is not None}:
        own = [r for r in rows if r[:3] == key]
        now = [r for r in own if r[5] == "Current"]
        count = lambda rs: len({r[3] for r in rs if r[3] is not None})
        if count(now):
            regions = ", ".join(sorted({r[4] for r in now if r[4] is not None})) or None
            want.append((*key, count(now), count([r for r in own if r[5] != "Current"]), count(own), regions, sum(r[6] or 0 for r in now), min((r[7] for r in own if r[7]), default=None), max((r[7] for r in now if r[7]), default=None)))
    columns = ["ch_company_name", "company_number", "company_status", "current_properties", "historical_properties", "total_properties_ever_owned", "current_regions", "total_current_value", "earliest_ownership", "latest_acquisition"]
    assert want
    assert sorted(map(str, map(tuple, timeline.company_portfolio(t).select(columns).collect()))) == sorted(map(str, want))


@tables
def test_company_portfolio_keeps_no_list_for_each_title(spark):
    aggregates = re.findall(r"Keys \[\d+\]: \[(.*)\]\nFunctions \[\d+\]: \[(.*)\]", formatted(spark, "company_portfolio"))
    assert not any("title_number" in keys and "collect_set" in made for keys, made in aggregates)


@tables
def test_names_are_looked_up_without_days(spark):
    assert not any("date_proprietor_added#" in c and ("number_key#" in c or "by_number#" in c or "_nk#" in c) for kind in ("Exchange", "SortMergeJoin", "Project") for c in nodes(spark, "match_asof_date", kind))


def test_matches_by_date_are_those_of_a_plain_loop(spark):
    from datetime import date
    from itertools import product

    days = [date(2000, 1, 1), date(2005, 5, 5), date(2010, 1, 1)]
    register = [("1", "A LTD", days[1], ["OLD"]), ("2", "A LIMITED", days[0], ["OLD", "GONE"]), ("3", "A", days[1], []), ("4", "B", days[2], ["OLD", "A"]), ("5", "C", None, ["GONE"]), ("6", "C LTD", None, ["ONCE"]), ("7", "D", days[0], ["B"])]
    key = lambda name: name.removesuffix(" LTD").removesuffix(" LIMITED")
    owners = list(product(["A", "A LTD", "B", "C", "D", "OLD", "GONE", "ONCE", "Z", " "], [None, "2", "9"], [None, date(1999, 1, 1), days[0], date(2007, 1, 1), date(2020, 1, 1)]))

    def last(of, day):
        known = [r for r in of if day and r[2] and r[2] <= day]
        return min((r for r in known if r[2] == max(k[2] for k in known)), key=lambda r: r[0], default=None)

    def match(name, number, day):
        if name == " ":
            return (None,) * 4
        by_number = [r for r in register if r[0] == number]
        if by_number:
            same = key(by_number[0][1]) == key(name)
            return by_number[0][1], number, *(("Name+Number", "1.00") if same else ("Number", "0.90"))
        named, former = ([r for r in register if key(name) == key(r[1])], [r for r in register if key(name) in r[3]])
        of, kind, one, many = (named, "Name", "0.70", "0.60") if named else (former, "Previous_Name", "0.50", "0.40")
        got = of[0] if len(of) == 1 else last(of, day)
        return (got[1], got[0], kind, one if len(of) == 1 else many) if got else (None, None, "No_Match", "0.00")

    got = resolve.resolve(
        spark.createDataFrame([(*o, "x") for o in owners], "proprietor_name string, company_reg_no string, date_proprietor_added date, category string"),
        spark.createDataFrame([(*r[:3], r[3]) for r in register], "company_number string, company_name string, incorporation_date date, previous_names array<string>"), resolve.BY_DATE,
    )
    want = sorted(str((*o, *match(*o))) for o in owners)
    columns = ["proprietor_name", "company_reg_no", "date_proprietor_added", "matched_name", "matched_number", "match_type", F.col("confidence").cast("string")]
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == want


@tables
def test_an_import_reads_its_files_once_and_deals_them_by_key(spark):
    text = formatted(spark, "import_files_once")
    assert len(re.findall(r"\(\d+\) Scan csv", text)) == 1
    assert "BroadcastHashJoin LeftAnti" in text and "SortMergeJoin" not in text


def test_upsert_in_one_pass_is_upsert(spark):
    from deedflow.operators.upsert import upsert, upsert_in_one_pass

    kinds = "a string, b int, at int, v string"
    table = spark.createDataFrame([("x", 1, 1, "old"), ("x", 2, 9, "old"), ("x", 2, 9, "twice"), ("y", 1, 5, "old"), (None, 1, 1, "old"), (None, 1, 2, "old too"), ("z", None, 1, "old"), ("y", 7, None, "p"), ("y", 7, None, "q")], kinds)
    new = spark.createDataFrame([("x", 1, 1, "new"), ("x", 1, 2, "newer"), ("x", 2, None, "new"), ("w", 1, None, "only"), (None, 1, 3, "new"), (None, 1, 4, "newer"), ("z", None, 2, "new")], kinds)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(upsert_in_one_pass(table, new, ["a", "b"], ["at", "v"])) == rows(upsert(table, new, ["a", "b"], ["at", "v"]))
    assert rows(upsert_in_one_pass(table.drop("at"), new, ["a", "b"], ["at"])) == rows(upsert(table.drop("at"), new, ["a", "b"], ["at"]))
    assert rows(upsert_in_one_pass(table.limit(0), new, ["a"], ["at", "v"])) == rows(upsert(table.limit(0), new, ["a"], ["at", "v"]))


def test_clean_drops_all_outer_white_space(spark):
    from deedflow.functions import text

    rows = [(" a  b ",), ("\u00a0\u2003a\u0085\tb\u3000\n",), ("\u2028",), ("",), (None,), ("x",)]
    got = spark.createDataFrame(rows, "c string").select(text.clean(F.col("c"))).collect()
    assert [r[0] for r in got] == ["a b", "a b", None, None, None, "x"]


@tables
@pytest.mark.parametrize("name,columns", [("stored_current_ownership", {"title_number", "owners", "last_company"}), ("stored_matches", {"title_number", "id", "slot", "proprietor_name", "matched_name", "matched_number", "match_type", "confidence"}), ("stored_timeline", None)])
def test_stored_views_keep_the_columns_asked_for(spark, name, columns):
    from deedflow import catalog
    from deedflow.plans import load_all

    load_all()
    got = catalog.QUERIES[name](spark, SF)
    assert set(spark.read.parquet(*got.inputFiles()).columns) == (columns or set(got.columns))


def odd_titles(spark):
    from datetime import date

    company = "Limited Company or Public Limited Company"
    rows = [(str(i), t, m and date(2020, m, 1), "D" if i % 5 == 0 else None, a, "1" if i % 2 else None, company if i % 4 else "Council", b, None, company) for i, (t, m, a, b) in enumerate([
        ("T1", 1, "A LTD", "B LTD"), ("T1", 2, "A LTD", "A LTD"), ("T1", 2, "", "A LTD"), ("T2", 1, " ", "C"), ("T2", 5, "C", " "), ("T3", 6, None, None), (None, 3, "A LTD", "C"), (None, 4, "A LTD", "A LTD"), ("T4", None, "Z", "A LTD"), ("T1", 9, None, ""), ("T1", 2, "A LTD", "B LTD"),
    ])]
    wide = spark.createDataFrame(rows, "id string, title_number string, file_month date, change_indicator string, proprietor_1_name string, company_1_reg_no string, proprietorship_1_category string, proprietor_2_name string, company_2_reg_no string, proprietorship_2_category string")
    register = spark.createDataFrame([("1", "A LIMITED", "Active", date(2000, 1, 1), ["C"]), ("2", "B LTD", "Active", date(2001, 1, 1), [])], "company_number string, company_name string, company_status string, incorporation_date date, previous_names array<string>")
    return wide, register


def test_matches_that_come_to_the_titles_are_those_fetched_by_owners(spark):
    from deedflow.operators import timeline

    wide, register = odd_titles(spark)
    want = timeline.resolved_owners(wide, register)
    got = timeline.resolved_owners(wide, register, deal=timeline.by_title)
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(map(str, df.select(sorted(want.columns)).collect()))
    assert len(rows(want)) == 17 and rows(got) == rows(want)
    text = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert not any("slot#" in c for c in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text))
    some = timeline.resolved_owners(wide, register, deal=timeline.by_title, only=(), match=("matched_number",))
    assert "confidence" not in some.columns and "category" not in some.columns and some.where("matched_number = '1'").count() == want.where("matched_number = '1'").count()


@tables
@pytest.mark.parametrize("name", ["latest_per_owner", "current_ownership", "recent_changes", "param_lookup", "status_by_dataset"])
def test_what_asks_for_no_match_makes_none(spark, name):
    assert "supplier.parquet" not in formatted(spark, name) and wide_exchanges(spark, name, "slot#") == 0


@tables
def test_titles_are_not_shuffled_for_their_companies_names(spark):
    assert wide_exchanges(spark, "wide_companies", "proprietor_") == wide_exchanges(spark, "wide_companies", "proprietor_name") and "SortMergeJoin" not in formatted(spark, "wide_companies").split("slot#")[-1]
    assert wide_exchanges(spark, "wide_companies", "slot#") == 2


def test_wide_companies_are_those_of_joins_slot_by_slot(spark):
    from deedflow.operators import slots, timeline

    wide, register = odd_titles(spark)
    wide = wide.withColumn("id", F.when(F.col("id") == "7", "1").when(F.col("id") != "6", F.col("id")))  # one twice, and one that is null
    wide = wide.withColumns({f"proprietor_{i}_name": F.lit(None).cast("string") for i in (3, 4)})
    found = resolve.resolve(slots.unpivot(wide), register)
    want = timeline.wide(wide, slots.pivot(found, ["id"], slots.MATCH), register)
    got = timeline.wide_companies(wide, register)
    rows = lambda df: sorted(map(str, df.select(got.columns).collect()))
    assert len(rows(got)) == 11 and rows(got) == rows(want)


@tables
@pytest.mark.parametrize("name", ["current_simplified"])
def test_reports_by_title_shuffle_no_rows_of_owners(spark, name):
    assert wide_exchanges(spark, name, "slot#") == 0
