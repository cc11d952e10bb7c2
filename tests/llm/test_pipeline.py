import random

import corpus_pipeline as cp
import pytest

import __spark_entry__ as entry
from deedflow.llm import pii
from tests.llm.test_jaccard_join import brute as brute_groups


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(9)
    langs = {"en": "the of and to in that was for with his".split(), "fr": "le la les de et un une dans pour avec".split(), "de": "der die das und ein nicht mit auf sich von".split()}
    rows = []
    for i in range(240):
        lang = rnd.choice(list(langs))
        rows.append((i, " ".join(rnd.choice(langs[lang]) + rnd.choice(["", "x", "y"]) for _ in range(rnd.randint(20, 90))), lang, f"s{i % 4}"))
    item = " ".join(f"bench{i}" for i in range(30))
    rows += [(500, rows[0][1], rows[0][2], "s0"), (501, rows[3][1] + " the", rows[3][2], "s1")]
    rows += [(510, rows[5][1] + " " + item, "en", "s1"), (511, "the of " + " ".join(item.split()[4:14]) + " and to", "en", "s1"), (512, "the of and " + " ".join(item.split()[:9]) + " to in that", "en", "s1")]
    rows += [(520, "the of and mail a.b@mail.example.com to in that was", "en", "s2"), (530, None, "en", "s1"), (531, "", "fr", "s1"), (532, "123 456", "de", "s1"), (540, "der die das und " * 2000, "de", "s3")]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


KEY = "a key for tests"


def stages(spark, path, tmp):
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, f in cp.STAGES:
        f(spark, docs, path).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        out[name] = docs
    return out


def test_each_stage_on_its_own_input(spark, tables, tmp_path):
    path, rows = tables
    spark.conf.set(pii.PII_KEY, KEY)
    got = stages(spark, path, str(tmp_path))
    spark.conf.unset(pii.PII_KEY)
    text = {n: {r.doc_id: r.text for r in d.collect()} for n, d in got.items() if n != "packing"}
    for n in text:
        assert got[n].columns == cp.COLUMNS
    # language: only documents without a letter, and few others, go
    gone = {r[0] for r in rows} - set(text["language_id"])
    assert {530, 531, 532} <= gone and len(gone) <= 6
    # near duplicates: the smallest id of each group
    left = sorted(text["language_id"].items())
    assert set(text["near_duplicates"]) == {d for d, _, c in brute_groups(left, 5, 80) if d == c}
    assert 500 not in text["near_duplicates"]
    # decontamination: ten words or more
    assert set(text["near_duplicates"]) - set(text["decontaminate"]) == {510, 511} & set(text["near_duplicates"])
    assert 512 in text["decontaminate"]
    fe = pii.Feistel(KEY.encode())
    assert text["pii"] == {d: pii.pseudonymise(t, lambda k, v: pii.MAPS[k](fe, v))[0] for d, t in text["decontaminate"].items()}
    assert "a.b@mail" not in text["pii"][520]
    words = {}
    for r in got["packing"].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
    assert words == {d: len(t.split()) for d, t in text["pii"].items()}


def test_run_and_registration(spark, tables):
    path, _ = tables
    assert entry.queries()["pipeline"](spark, path).count() > 200
    assert "pipeline" not in entry.oracle_sql()
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates", "decontaminate", "pii", "packing"]


def test_empty_and_repeated_rows(spark, tables, tmp_path):
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    bench = spark.read.parquet(f"{path}/benchmark.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/a/documents.parquet")
    bench.limit(0).write.parquet(f"{tmp_path}/a/benchmark.parquet")
    assert cp.run(spark, f"{tmp_path}/a").collect() == []
    odd = docs.withColumns({c: docs.doc_id for c in ("id", "h", "node", "rejected", "n_email", "key")})
    for _, stage in cp.STAGES[:-1]:  # extra columns, also with clashing names, are left out
        assert stage(spark, odd.limit(50), path).columns == cp.COLUMNS
    twice = docs.where("doc_id in (1, 2)").unionByName(docs.where("doc_id = 1"))
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, twice, path).collect()) == [1, 2]
