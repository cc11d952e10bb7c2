"""Stored views, the ledger, statistics from changes, times of change, pages, database reads and SQL lookups."""

import bz2
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from deedflow.functions import html
from deedflow.operators import analytics, company_state, ledger, refresh, upsert
from deedflow.sources import pages, tables
from deedflow.sources.stored import Conflict, Stored

ROWS = "title_number string, v int"


def rows(spark, *x):
    return spark.createDataFrame(list(x), ROWS)


def seen(df):
    return sorted(((r.title_number, r.v) for r in df.collect()), key=str)


def test_a_reader_stays_with_its_version_while_the_table_is_refreshed(spark, tmp_path):
    t = Stored(spark, f"file://{tmp_path}/t", ("title_number",), buckets=4)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.write(rows(spark, ("a", 1), ("b", 2), ("b", 3), (None, 4)))
    reader = t.read()
    assert t.replace(rows(spark, ("b", 0), ("c", 0)), rows(spark, ("c", 9))) == 1
    assert seen(t.read()) == [("a", 1), ("c", 9), (None, 4)]
    assert seen(reader) == seen(t.read(0)) == [("a", 1), ("b", 2), ("b", 3), (None, 4)]
    t.replace(rows(spark, (None, 0)), rows(spark))
    assert seen(t.read()) == [("a", 1), ("c", 9)] and t.versions() == [0, 1, 2]
    assert t.vacuum(keep=1) > 0 and t.versions() == [2] and seen(t.read()) == [("a", 1), ("c", 9)]
    t.write(rows(spark))
    assert seen(t.read()) == [] and seen(Stored(spark, t.path, t.key, 4).read(2)) == [("a", 1), ("c", 9)]


def test_a_refresh_writes_only_the_buckets_of_its_keys(spark, tmp_path):
    t = Stored(spark, f"file://{tmp_path}/t", ("title_number",), buckets=8)
    t.write(rows(spark, *[(f"t{i}", i) for i in range(100)]))
    before = t._manifest(0)["folders"]
    t.replace(rows(spark, ("t7", 0)), rows(spark, ("t7", -7)))
    after = t._manifest(1)["folders"]
    assert len([b for b in before if before[b] != after[b]]) == 1
    assert seen(t.read()) == sorted([(f"t{i}", -7 if i == 7 else i) for i in range(100)], key=str)
    assert t.replace(rows(spark), rows(spark)) == 1  # nothing changed, no version


def test_of_two_writers_from_one_version_one_wins_and_a_killed_one_leaves_no_trace(spark, tmp_path, monkeypatch):
    t = Stored(spark, f"file://{tmp_path}/t", ("title_number",), buckets=2)
    t.write(rows(spark, ("a", 1)))
    monkeypatch.setattr(t, "version", lambda: 0)
    t.replace(rows(spark, ("a", 0)), rows(spark, ("a", 2)))
    with pytest.raises(Conflict):
        t.replace(rows(spark, ("a", 0)), rows(spark, ("a", 3)))
    other = Stored(spark, t.path, t.key, 2)
    assert seen(other.read()) == [("a", 2)]
    monkeypatch.setattr(other, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        other.write(rows(spark, ("z", 1)))
    assert seen(Stored(spark, t.path, t.key, 2).read()) == [("a", 2)]


def test_changed_keys_and_titles_of_changed_companies(spark):
    old = rows(spark, ("same", 1), ("same", 1), ("twice", 1), ("gone", 1), ("value", 1), (None, 1))
    new = rows(spark, ("same", 1), ("same", 1), ("twice", 1), ("twice", 1), ("new", 1), ("value", None), (None, 1))
    assert {r[0] for r in refresh.changed_keys(old, new, ["title_number"]).collect()} == {"twice", "gone", "value", "new"}
    head = "company_number string, company_name string, incorporation_date date, previous_names array<string>"
    a = spark.createDataFrame([("1", "ALPHA LTD", None, []), ("2", "BETA LTD", None, ["OMEGA"]), ("3", "GAMMA", None, None)], head)
    b = spark.createDataFrame([("1", "ALPHA LTD", None, []), ("2", "BETA LTD", None, []), ("4", "DELTA", None, None), ("3", "GAMMA", None, None)], head)
    owners = spark.createDataFrame([("t1", "Alpha", "1"), ("t2", "Omega Ltd", ""), ("t3", "x", "00000004"), ("t4", "gamma", "3"), ("t5", "", "2"), ("t6", "delta plc", None)], "title_number string, proprietor_1_name string, company_1_reg_no string")
    assert {r[0] for r in refresh.titles_of_companies(owners, a, b).collect()} == {"t2", "t3", "t6"}


T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_ledger_folds_and_takes_up_abandoned_files(spark, tmp_path):
    log = f"file://{tmp_path}/log"
    assert ledger.read(spark, log).count() == 0
    clock = [0]
    done = []

    def now():
        clock[0] += 1
        return at(clock[0])

    def work(name):
        if name == "bad":
            raise ValueError(name)
        if name == "killed" and not done:
            raise KeyboardInterrupt  # as if the process died
        done.append(name)
        return 10

    with pytest.raises(KeyboardInterrupt):
        ledger.run_imports(spark, log, ["bad", "killed", "later"], work, now)
    state = {r.source_filename: (r.state, r.attempts) for r in ledger.fold(ledger.read(spark, log)).collect()}
    assert state == {"bad": ("failed", 1), "killed": ("running", 1)}
    done.append("restarted")
    assert ledger.run_imports(spark, log, ["bad", "killed", "later"], work, now) == {"bad": "failed", "later": "completed"}  # killed may still run
    clock[0] += 120
    assert ledger.run_imports(spark, log, ["bad", "killed", "later"], work, now) == {"bad": "failed", "killed": "completed"}
    assert ledger.run_imports(spark, log, ["bad", "killed", "later"], work, now) == {}  # bad has failed three times
    got = {r.source_filename: (r.state, r.attempts, r.rows, r.completed_again) for r in ledger.fold(ledger.read(spark, log)).collect()}
    assert got == {"bad": ("failed", 3, 0, 0), "killed": ("completed", 2, 10, 0), "later": ("completed", 1, 10, 0)}
    assert done == ["restarted", "later", "killed"]


def test_the_first_completion_counts_in_any_order_of_the_log(spark):
    log = [("f", "completed", at(5), "b", 7, 0), ("f", "running", at(1), "a", None, None), ("f", "completed", at(9), "a", 8, 0), ("f", "failed", at(10), "c", None, 2), ("f", "odd", at(11), "d", None, None), ("g", "running", at(1), "a", None, None), ("g", "failed", at(1), "a", None, None)]
    for events in (log, log[::-1]):
        got = {r.source_filename: (r.state, r.rows, r.ended_at, r.run, r.completed_again, r.errors) for r in ledger.fold(spark.createDataFrame(events, ledger.SCHEMA)).collect()}
        assert got == {"f": ("completed", 7, at(5), "b", 1, 0), "g": ("failed", 0, at(1), "a", 0, 0)}


def test_statistics_from_changes_equal_a_rebuild(spark):
    head = "company_reg_no string, title_number string, price_paid long, proprietor_name string, category string, country_incorporated string, date_proprietor_added date"
    one = [("1", "t1", 5, "A", "c", None, date(2000, 1, 1)), ("1", "t1", 5, "A", "c", None, date(2000, 1, 1)), ("1", "t2", 7, "B", "c", "JE", None), ("2", "t3", None, "C", None, None, None), (None, "t4", 1, "D", "c", None, None)]
    two = [("1", "t9", 5, "Z", "c", None, date(1999, 1, 1)), ("3", "t5", 4, "E", "c", None, None)]
    frame = lambda x: spark.createDataFrame(x, head)
    held = company_state.advance(company_state.state(frame(one)), frame(two), frame(one[1:3]))
    left = [one[0], *one[3:], *two]
    show = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    assert show(company_state.statistics(held)) == show(analytics.company_stats(frame(left)))
    gone = company_state.advance(held, frame([]), frame(left))
    assert gone.count() == 0 and company_state.statistics(gone).count() == 0


def test_only_changed_rows_get_a_new_time(spark):
    old = spark.createDataFrame([(1, "a", None, "then"), (2, "b", 1.0, "then"), (3, None, None, "then"), (4, "d", 1.0, None)], "k int, v string, n double, updated_at string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (2, "b", 1.5), (3, None, None), (5, "e", None), (4, "d", 1.0)], "k int, v string, n double")
    got = sorted(map(tuple, upsert.upsert_stamped(old, new, ["k"], ["n"], "now").collect()))
    assert got == [(1, "a", None, "then"), (2, "b", 2.0, "now"), (3, None, None, "then"), (4, "d", 1.0, None), (5, "e", None, "now")]


def test_pages_from_blobs(spark, tmp_path):
    page = "<div class='mortgage-1'><h2><a>Charge code 12 34</a></h2><dd id='mortgage-created-on'>3 May 2020</dd><p id='mortgage-particulars'>floating Charge, Zoë</p></div>"
    whole = "".join(page.replace("12 34", f"{i}") for i in range(5000)) + "<div class='mortgage-x'></div>"
    folder = tmp_path / "blobs"
    folder.mkdir()
    (folder / "01.html.bz2").write_bytes(bz2.compress(page[:40].encode()) + bz2.compress(page[40:].encode()))
    (folder / "02.html.bz2").write_bytes(page.encode())
    (folder / "03.html.bz2").write_bytes(b"BZh9 broken")
    (folder / "04.html.bz2").write_bytes(bz2.compress(whole.encode()))
    (folder / "05.html.bz2").write_bytes(b"")
    (folder / "06.html").write_bytes(page.encode())
    got = pages.charge_lists(pages.read_blobs(spark, str(folder)))
    first = got.where("company_number < '04'").orderBy("charge_id").collect()
    assert [(r.company_number, r.charge_id, r.code, r.created_on, r.charge_type, r.persons_entitled) for r in first] == [(n, f"{n}_charge_1", "12 34", date(2020, 5, 3), "Floating charge", None) for n in ("01", "02")]
    assert got.where("company_number = '04'").count() == 5001
    assert "".join(html.texts(bz2.compress("é".encode() * 200_000))) == "é" * 200_000
    assert html.tree(bz2.compress(page.encode())[:-9]).text() == html.tree(page).text()  # broken off after its block
    nothing = pages.overviews(spark.createDataFrame([("1", None)], "company_number string, page binary")).first()
    assert nothing.company_status is None and nothing.sic_codes == []


def test_ranges_of_a_skewed_key_hold_about_as_many_rows(spark):
    url, driver = "jdbc:derby:memory:ranges;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    i = F.col("id")
    made = spark.range(4000).select(F.when(i < 3000, i % 700).when(i < 3900, 10**9 + i * 1000).cast("long").alias("K"), i.alias("V"))
    made.coalesce(1).write.format("jdbc").options(url=url, dbtable="T", driver=driver).mode("overwrite").save()
    made.limit(0).write.format("jdbc").options(url=url, dbtable="E", driver=driver).mode("overwrite").save()
    got = tables.jdbc(spark, url, "T", "K", 8, driver=driver)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 4000 / 8
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, made.collect()), key=str)
    assert tables.jdbc(spark, url, "E", "K", 8, driver=driver).count() == 0
    assert tables.jdbc(spark, url, "T", driver=driver).count() == 4000


def test_lookup_in_sql_filters_at_the_scan(spark, tmp_path):
    df = spark.range(300).select(F.concat(F.lit("T"), i := F.col("id") % 30).alias("title_number"), (i % 4).cast("string").alias("matched_number"), F.lit("AB").alias("postcode"), F.lit(date(2020, 1, 1)).alias("file_month"), "id")
    df.write.parquet(str(tmp_path / "h"))
    tables.register_views({"history_view": spark.read.parquet(str(tmp_path / "h"))})
    tables.register_lookup(spark, "history_view", "history_of")
    got = spark.sql("SELECT id FROM history_of(title => 'T5', month => DATE '2020-01-01')")
    assert sorted(r.id for r in got.collect()) == [i for i in range(300) if i % 30 == 5]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(title_number,T5)" in plan and "postcode" not in plan
    assert spark.sql("SELECT * FROM history_of()").count() == 300
    assert spark.sql("SELECT * FROM history_of('T1', '9')").count() == 0
