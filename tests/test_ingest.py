"""Files to tables: snapshots, register, persons of control, merges, ledger and stream."""

import csv
from datetime import date

import pytest
from pyspark.sql import functions as F

from deedflow.operators import resolve, slots, timeline, upsert
from deedflow.sources import companies, psc, tables, titles
from deedflow.streaming import ingest

HEAD = ["Title Number", "Tenure", "Price Paid", "Proprietor Name (1)", "Company Registration No. (1)", "Proprietorship Category (1)", "Proprietor Name (2)", "Date Proprietor Added", "Change Indicator", "Change Date", "Postcode"]


def write(folder, name, rows, head=HEAD):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(head)
        w.writerows(rows)


def row(title, price="100", owner="ACME LTD", change="", added="01-02-2019", **k):
    return [title, " Freehold ", price, owner, "123", "Limited Liability Partnership", "", added, change, k.get("day", ""), "AB1 2CD"]


@pytest.fixture
def folder(tmp_path):
    f = tmp_path / "in"
    write(f, "CCOD_FULL_2020_01.csv", [row("T1"), row("T2", price="bad", owner='QUOTED, "X"\nLTD'), row("T1", price="200")])
    write(f, "CCOD_COU_2020_01.csv", [row("T1", price="1"), row("T3", change="D"), row("T4", change="A", added="2019-02-01")])
    write(f, "notes_2020.csv", [row("T9")])
    return f


def test_titles(spark, folder):
    got = {(r.title_number, r.source_filename, r.price_paid) for r in titles.read_titles(spark, str(folder)).collect()}
    assert got == {("T1", "CCOD_FULL_2020_01.csv", 100), ("T1", "CCOD_FULL_2020_01.csv", 200), ("T2", "CCOD_FULL_2020_01.csv", None), ("T1", "CCOD_COU_2020_01.csv", 1), ("T4", "CCOD_COU_2020_01.csv", 100)}
    assert titles.read_titles(spark, str(folder), keep_deletes=True).count() == 6
    r = titles.read_titles(spark, str(folder)).where("title_number = 'T2'").first()
    assert (r.file_month, r.update_type, r.tenure, r.proprietor_1_name, r.date_proprietor_added, r.proprietor_3_name) == (date(2020, 1, 1), "FULL", "Freehold", 'QUOTED, "X" LTD', date(2019, 2, 1), None)


def test_import_with_ledger(spark, folder, tmp_path):
    new = titles.read_titles(spark, str(folder))
    ledger = spark.createDataFrame([], "source_filename string, file_month date, rows long, status string")
    table, ledger = titles.import_titles(new.limit(0), ledger, new)
    # FULL sorts after COU, and within a file the last row wins
    assert {(r.title_number, r.price_paid) for r in table.collect()} == {("T1", 200), ("T2", None), ("T4", 100)}
    assert {(r.source_filename, r.rows) for r in ledger.collect()} == {("CCOD_FULL_2020_01.csv", 3), ("CCOD_COU_2020_01.csv", 2)}
    again, same = titles.import_titles(table, ledger, new)
    assert again.count() == 3 and same.count() == 2
    path = str(tmp_path / "table")
    tables.write_partitions(table, path)
    tables.write_partitions(table.where("title_number = 'T1'").withColumn("file_month", F.lit(date(2020, 2, 1))), path)
    assert spark.read.parquet(path).count() == 4
    tables.export_csv(table.select("title_number"), str(tmp_path / "csv"), ["title_number"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    assert [r.title_number for r in tables.export_rows(table.orderBy("title_number"))] == ["T1", "T2", "T4"]
    assert tables.ledger_entry(spark, "f", "running").first().status == "running"


def test_stream_takes_each_file_once_and_upserts(spark, folder, tmp_path):
    path, check = str(tmp_path / "table"), str(tmp_path / "check")
    (folder / "notes_2020.csv").unlink()
    ingest.ingest(ingest.title_files(spark, str(folder), HEAD), path, check).awaitTermination()
    assert {r.title_number for r in spark.read.parquet(path).collect()} == {"T1", "T2", "T4"}
    write(folder, "OCOD_FULL_2020_01.csv", [row("T1", price="300")])
    write(folder, "OCOD_FULL_2020_02.csv", [row("T1", price="400")])
    ingest.ingest(ingest.title_files(spark, str(folder), HEAD), path, check).awaitTermination()
    got = {(r.title_number, r.file_month.month): r.price_paid for r in spark.read.parquet(path).collect()}
    assert got[("T1", 1)] == 300 and got[("T1", 2)] == 400 and len(got) == 4


def test_companies(spark, tmp_path):
    head = [" CompanyNumber", "CompanyName", "CompanyStatus", "IncorporationDate", "Mortgages.NumMortCharges", "PreviousName_1.CompanyName", "PreviousName_1.CONDATE", "SICCode.SicText_1"]
    write(tmp_path / "c", "BasicCompanyDataAsOneFile-2020-01-01.csv", [["1", "A LTD", "Active", "01/02/2000", "x", "OLD A", "3/4/2010", "None Supplied"], ["", "B", "Active", "", "1", "", "", ""], ["2", "none", "Active", "2000-2-1", "3", "", "", ""]], head)
    got = companies.read_companies(spark, str(tmp_path / "c")).orderBy("company_number").collect()
    assert [(r.company_number, r.company_name, r.incorporation_date, r.mortgages_num_charges, r.previous_names) for r in got] == [("1", "A LTD", date(2000, 2, 1), None, ["OLD A"]), ("2", None, date(2000, 2, 1), 3, [])]
    assert companies.latest_file(["/a/BasicCompanyDataAsOneFile-2020.csv", "/b/BasicCompanyDataAsOneFile-2021.csv", "/z.csv"]).endswith("2021.csv")
    with pytest.raises(FileNotFoundError):
        companies.latest_file([])


def test_scraped_and_rescraped(spark):
    raw = spark.createDataFrame([("a", "FOUND", "A LTD", "1", "62020, 01110", "X | Y", "1 May 2001")], ["search name", "status", "Found Name", "Company Number", "SIC Codes", "Previous Names", "Incorporated On"])
    r = companies.parse_scraped(raw).first()
    assert (r.search_status, r.company_name, r.sic_codes, r.previous_names, r.incorporation_date, r.reg_address_full) == ("FOUND", "A LTD", ["62020", "01110"], ["X", "Y"], date(2001, 5, 1), None)
    main = spark.createDataFrame([("A ", "ERROR", "1"), ("B", "FOUND", "2"), ("C", "ERROR", "3")], ["Search Name", "Status", "Company Number"])
    again = spark.createDataFrame([(" a", "FOUND", "9", "why"), ("b", "NOT_FOUND", "8", "")], ["Search Name", "Status", "Company Number", "Original Error"])
    assert sorted(map(tuple, companies.merge_rescraped(main, again).collect())) == [(" a", "FOUND", "9"), ("B", "FOUND", "2"), ("C", "ERROR", "3")]


def test_psc(spark, tmp_path):
    lines = ['{"company_number": "1", "data": {"kind": "individual-x", "etag": "e", "address": {"address_line_1": "L1", "postal_code": "P"}, "notified_on": "2020-01-02", "extra": 1}}', "", "{bad", '{"company_number": "", "data": {}}', '{"company_number": "1", "data": {"kind": "legal-person"}}']
    path = tmp_path / "persons-with-significant-control-snapshot-1.txt"
    path.write_text("\n".join(lines * 2))
    got = psc.read_psc(spark, str(tmp_path / "persons-with-significant-control-snapshot-*.txt"))
    assert got.count() == 4 and got.where("etag = 'e'").first().address_line_1 == "L1" and got.where("etag = 'e'").first().notified_on == date(2020, 1, 2)
    merged = psc.import_psc(got.limit(0), got)
    assert sorted((r.etag or "", r.psc_kind) for r in merged.collect()) == [("", "legal-person")] * 2 + [("e", "individual")]


def test_resolution_by_hand(spark):
    register = spark.createDataFrame(
        [("00000001", "ALPHA LTD", date(2000, 1, 1), ["OMEGA LTD"]), ("00000002", "BETA LTD", date(2000, 1, 1), []), ("00000003", "BETA PLC", date(2010, 1, 1), []), ("00000004", "COSTA LTD", date(2000, 1, 1), [])],
        "company_number string, company_name string, incorporation_date date, previous_names array<string>",
    )
    llp = "Limited Liability Partnership"
    owners = spark.createDataFrame(
        [(1, "alpha limited", "1", llp), (2, "other", "1", llp), (3, "BETA", None, llp), (4, "Omega", "", llp), (5, "NOBODY", "X" * 30, llp), (6, "ALPHA", "1", "Council"), (7, " ", "1", llp), (8, "COSTA LTD", None, llp), (9, None, None, None)],
        "id int, proprietor_name string, company_reg_no string, category string",
    ).withColumn("date_proprietor_added", F.lit(date(2005, 1, 1)))

    def run(rules):
        return {r.id: (r.match_type, r.matched_number, float(r.confidence) if r.confidence is not None else None) for r in resolve.resolve(owners, register, rules).collect()}

    got = run(resolve.PRODUCTION)
    assert got == {1: ("Name+Number", "00000001", 1.0), 2: ("Number", "00000001", 0.9), 3: ("Name", "00000002", 0.7), 4: ("Previous_Name", "00000001", 0.5), 5: ("Land_Registry", "X" * 20, 0.3), 6: ("Not_Company", None, 0.0), 7: (None, None, None), 8: ("Land_Registry", None, 0.3), 9: (None, None, None)}
    assert run(resolve.REJECTING)[3] == ("No_Match", None, 0.0)
    assert run(resolve.BY_DATE)[3] == ("Name", "00000002", 0.6)
    assert run(resolve.CLASSIC)[6] == ("Name+Number", "00000001", 1.0)


def test_upserts_by_hand(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "", 7), (2, None, 8), (3, "c", None)], "k int, v string, n int")
    assert sorted(map(tuple, upsert.upsert(old, new, ["k"], ["n"]).collect()), key=str) == [(1, "a", 5), (2, None, 8), (3, "c", None)]
    assert sorted(map(tuple, upsert.upsert_filling(old, new, ["k"], ["n"]).collect()), key=str) == [(1, "a", 5), (2, "b", 8), (3, "c", None)]
    assert sorted(r.k for r in upsert.insert_new(old, new, ["k"]).collect()) == [1, 2, 3]
    long = slots.unpivot(spark.createDataFrame([(1, "x", "", "y")], "id int, proprietor_1_name string, proprietor_2_name string, proprietor_3_name string"))
    assert [(r.slot, r.proprietor_name) for r in long.collect()] == [(1, "x"), (3, "y")]


def test_repeated_owners_come_back_as_often_as_they_came(spark):
    owners = spark.createDataFrame([("A LTD", "00000012", {"k": 1})] * 2 + [("B LTD", None, {}), ("OLD B", "", {})], "proprietor_name string, company_reg_no string, extra map<string,int>")
    scraped = spark.createDataFrame([("12", "A", None), ("77", "b ltd", ["Old B"])], "company_number string, company_name string, previous_names array<string>")
    got = sorted((r.proprietor_name, r.company_number, float(r.confidence)) for r in resolve.match_by_spellings(owners, scraped).collect())
    assert got == [("A LTD", "12", 1.0)] * 2 + [("B LTD", "77", 0.9), ("OLD B", "77", 0.9)]


def test_a_repeated_company_number_multiplies_no_owner(spark):
    long = spark.createDataFrame([("t", "1")], "title_number string, matched_number string")
    register = spark.createDataFrame([("1", "B", "Active"), ("1", "A", "Active")], "company_number string, company_name string, company_status string")
    assert [r.ch_company_name for r in timeline._with_company(long, register).collect()] == ["A"]


def test_stored_matches_are_read_and_a_refresh_replaces_them(spark):
    rows = lambda *x: spark.createDataFrame([(i, "t") for i in x], "id long, match_type string")
    name = "stored_matches_test"
    assert sorted(r.id for r in tables.materialise(rows(1, 2), name).collect()) == [1, 2]
    assert sorted(r.id for r in tables.materialise(rows(3), name).collect()) == [3] == [r.id for r in spark.table(name).collect()]
    spark.sql(f"DROP TABLE {name}")


def test_reload_truncates(spark, tmp_path):
    tables.reload(spark.range(5), str(tmp_path / "t"))
    tables.reload(spark.range(2), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_streamed_rows_without_a_match(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    missing = ingest.match_missing(stream, spark.createDataFrame([(1,), (1,), (4,)], "id long"))
    missing.writeStream.format("memory").queryName("missing_rows").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.table("missing_rows").collect()) == [0, 2, 3, 5]
