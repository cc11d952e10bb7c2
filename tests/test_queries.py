"""Every query of the catalog against its oracle on the smallest tables, and the shape of important plans."""

import math
import os
import re

import duckdb
import pytest

from deedflow import catalog
from deedflow.plans import load_all

load_all()
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def tidy(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_oracle(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(tidy(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.ORACLES:
        assert got
        return
    out = db.execute(catalog.ORACLES[name])
    names = [c[0] for c in out.description]
    assert sorted(names) == columns
    want = sorted(tuple(tidy(r[names.index(c)]) for c in columns) for r in out.fetchall())
    assert got == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["unpivot_slots", "tiered_match", "match_number_variants", "array_member_join", "ownership_summary", "wide_companies"])
def test_no_nested_loops_and_one_scan_of_titles(spark, name):
    shown = plan(catalog.QUERIES[name](spark, SF))
    assert "NestedLoop" not in shown and "Cartesian" not in shown
    # match_number_variants reads the distinct numbers by themselves: one column, instead of each row once for each spelling.
    # Matches read what tells owners apart by itself, and shuffle it as distinct values: whole rows are then shuffled once, not for each tier.
    scans = {"wide_companies": 3, "match_number_variants": 2, "tiered_match": 2, "ownership_summary": 2}
    assert shown.count("lineitem.parquet") <= scans.get(name, 1)


def exchanges(spark, df):
    """The columns of each exchange of a plan."""
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


@pytest.mark.parametrize("name", ["tiered_match", "match_classic", "match_asof_date"])
def test_whole_owner_rows_are_shuffled_once(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert sum("slot#" in columns for columns in exchanges(spark, df)) <= 1  # none where the results are small enough to be broadcast
    assert "collect_set" not in plan(df)


def test_scan_reads_only_what_a_query_needs(spark):
    shown = plan(catalog.QUERIES["json_extract"](spark, SF))
    assert "event_type" not in shown and "props" in shown


def test_owners_from_stored_matches_agree_with_matches_on_the_way(spark):
    from deedflow.operators import slots, timeline
    from deedflow.plans.matching import matched
    from deedflow.plans.testdata import companies, titles

    t, c, m = titles(spark, SF), companies(spark, SF), matched(spark, SF)
    columns = ["id", "slot", "title_max_month", "match_type", "ch_company_name"]
    direct = sorted(map(str, timeline.resolved_owners(t, c).select(*columns).collect()))
    assert direct == sorted(map(str, timeline.owners(t, m.select("id", "slot", *slots.MATCH), c).select(*columns).collect()))
    assert direct == sorted(map(str, timeline.owners(t, slots.pivot(m, ["id"], slots.MATCH), c).select(*columns).collect()))


def test_rows_without_a_key_are_spread_over_tasks(spark):
    from pyspark.sql import functions as F

    from deedflow.operators.joins import spread

    rows = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, "").alias("k"))
    keys = rows.select(spread(F.col("k"), rows).alias("k"))
    assert keys.distinct().count() > 1000 and keys.where("k is null or k = ''").count() == 0
    assert spark.range(3).select(spread(F.lit("x"), spark.range(3)).alias("k")).distinct().count() == 1
