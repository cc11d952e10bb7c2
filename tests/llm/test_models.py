import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deedflow.llm import lang_id, quality, textvec

LANGS = {"en": "the of and to in that was for with his".split(), "fr": "le la les de et un une dans pour avec".split(), "de": "der die das und ein nicht mit auf sich von".split()}


def rows(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(LANGS))
        good = rnd.random() < 0.7
        words = [rnd.choice(LANGS[lang]) + rnd.choice("aeiou") for _ in range(rnd.randint(3, 60))]
        text = (" ".join(words).capitalize() + ". ") * 2 if good else " | ".join([words[0]] * len(words)) + " $$$ 12"
        out.append((i, text, lang, int(good)))
    return out


ODD = [(9001, None, None, None), (9002, "", "en", 0), (9003, "123 !", "fr", None), (9004, "the of and " * 30_000, "en", 1), (9004, "the of and " * 30_000, "en", 1), (None, "le la les", "fr", 1), (9005, "a", None, None)]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    spark.createDataFrame([(*r[:3], "s", 0.5) for r in rows(1, 600) + ODD], "doc_id long, text string, lang string, source string, score double").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], r[3], 0) for r in rows(1, 600) + ODD], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_language_held_out_accuracy_and_odd_rows(spark, path):
    got = lang_id.op4_language_id(spark, path).collect()
    truth = {r[0]: r[2] for r in rows(1, 600)}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    by = {r.doc_id: r for r in got}
    assert len(got) == 607
    for i in (9001, 9002, 9003):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[9004].lang_pred == "en" and by[9005].lang_pred in LANGS and all(0 <= r.score <= 1 for r in got)


def test_language_without_labels_or_rows(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = lang_id.train(docs, F.lit(False))
    assert {r.lang_pred for r in lang_id.predict(docs, model, ["doc_id"]).collect()} == {"und"}
    assert lang_id.predict(docs.limit(0), model, ["doc_id"]).collect() == []


def test_language_rejects_random_letters_and_unlearned_languages(spark):
    rnd = random.Random(11)
    junk = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(5, 60))) for _ in range(100)]
    data = [(i, t, g) for i, t, g, good in rows(4, 4000) if good]
    docs = spark.createDataFrame([(i, t, None if g == "de" else g) for i, t, g in data] + [(9000 + i, t, None) for i, t in enumerate(junk)], "doc_id long, text string, lang string")
    model = lang_id.train(docs, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r.rejected for r in lang_id.predict(docs, model, ["doc_id"]).collect()}
    share = lambda ids: np.mean([got[i] for i in ids])
    assert share(range(9000, 9100)) == 1.0
    assert share([i for i, _, g in data if g == "de"]) >= 0.9
    assert share([i for i, _, g in data if g != "de" and i % 3 == 1]) <= 0.01


def test_temperature_stays_finite_where_every_row_is_right():
    y = np.arange(300) % 3
    z = 5.0 * np.eye(3)[y]
    assert 1e-2 < lang_id.temperature(z, y) < 1e2


def test_segments_add_up(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcé .") for _ in range(rnd.randint(0, 90))) for _ in range(60)]
    grid = np.random.default_rng(1).normal(size=(lang_id.BUCKETS, 2)).astype(np.float32)
    model = lang_id.Model(["x", "y"], grid, np.zeros(2), 0.0)
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts), pa.array([any(c.isalpha() for c in t) for t in texts])], names=["doc_id", "t", "l"])
    whole = next(lang_id.score_batches(model, ["doc_id"])([batch])).column("score").to_numpy()
    monkeypatch.setattr(lang_id, "SEGMENT", 7)
    assert np.allclose(next(lang_id.score_batches(model, ["doc_id"])([batch])).column("score").to_numpy(), whole)
    for t, s in zip(texts, whole, strict=True):
        parts = [grid[b] for _, b in lang_id.ngrams(lang_id.SYMBOL[np.frombuffer(t.encode(), np.uint8)])]
        if any(len(p) for p in parts) and any(c.isalpha() for c in t):
            assert np.isclose(lang_id.softmax(np.concatenate(parts).mean(axis=0)).max(), s, atol=1e-5)


def test_quality_held_out_accuracy_and_odd_rows(spark, path):
    got = quality.op1_quality(spark, path).collect()
    truth = {r[0]: r[3] for r in rows(1, 600)}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 607 and len(held) > 60
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_without_labels_or_rows(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stats = quality.document_statistics(docs, ["doc_id"])
    model = quality.train(stats, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert {r.score for r in quality.predict(stats, model, ["doc_id"]).collect()} == {0.5}
    assert quality.predict(quality.document_statistics(docs.limit(0), ["doc_id"]), model, ["doc_id"]).collect() == []


def test_quality_against_a_direct_fit(spark, path):
    stats = quality.document_statistics(spark.read.parquet(f"{path}/documents.parquet"), ["doc_id"])
    labels = spark.read.parquet(f"{path}/labels.parquet")
    model = quality.train(stats, labels, F.col("doc_id") % 2 == 0)
    given = {}
    for r in labels.collect():
        if r.doc_id is not None and r.quality is not None:
            given.setdefault(r.doc_id, []).append(float(r.quality > 0))
    known = [(r.stats, y, r.held) for r in stats.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0).collect() if r.doc_id is not None and r.doc_id % 2 == 0 for y in given.get(r.doc_id, [])]
    x, y, held = np.array([k[0] for k in known]), np.array([k[1] for k in known]), np.array([k[2] for k in known])
    assert len(known) > 200 and np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale[x.std(axis=0) > 1e-3], x.std(axis=0)[x.std(axis=0) > 1e-3])
    # Ridge as least squares over rows that pull each weight to 0, without normal equations.
    z = model.features(x[~held])
    pull = np.sqrt(np.full(z.shape[1], quality.RIDGE * len(z)))
    pull[0] = np.sqrt(1e-9 * len(z))
    weights = np.linalg.lstsq(np.vstack([z, np.diag(pull)]), np.append(y[~held], np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(model.features(x) @ weights, model.raw(x), atol=1e-4)
    # The features' products approximate the Gaussian kernel.
    near = np.clip((x[:80] - model.mean) / model.scale, -8, 8)
    apart = ((near[:, None] - near[None]) ** 2).sum(axis=2)
    f = model.features(x[:80])[:, 1:]
    assert np.abs(f @ f.T - np.exp(-apart / (2 * quality.WIDTH**2 * len(quality.STATS)))).mean() < 0.08


def test_statistics_of_a_text():
    texts = ["Aa bb. Aa\nAa bb. Aa\n\nx1", "", "é"]
    got = dict(zip(quality.STATS, quality.statistics(*textvec.flat(pa.array(texts)))[0], strict=True))
    assert np.isclose(got["log_words"], np.log1p(7)) and np.isclose(got["distinct_words"], 4 / 7) or np.isclose(got["distinct_words"], 3 / 7)
    assert np.isclose(got["lines"], np.log1p(3)) and np.isclose(got["repeated_lines"], 1 / 3) and np.isclose(got["ends_stop"], 0)
    assert np.isclose(got["starts_upper"], 4 / 7) and np.isclose(got["mixed_words"], 1 / 7)


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([10.0] * 4), np.array([1.0, 5, 3, 9]))
    assert np.allclose(x, [0, 1.5, 3]) and np.allclose(y, [0.1, 0.4, 0.9])


def test_shingle_sets_against_python():
    rnd = random.Random(2)
    texts = [rnd.choice([" ", "\n", "\x0b\t"]).join(rnd.choice(["a", "B", "b", "é", "É", "ccc"]) for _ in range(rnd.randint(0, 12))) for _ in range(300)] + [None, " x ", "\x1f"]
    doc, hs = textvec.shingle_sets(*textvec.flat(pa.array(texts)), 3)
    seen = {}
    for i, t in enumerate(texts):
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in (t or "").replace("\n", " ").replace("\x0b", " ").replace("\t", " ").split(" ") if x]
        want = {tuple(w[a : a + 3]) for a in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
        got = hs[doc == i]
        assert len(got) == len(want)
        key = frozenset(want)
        assert seen.setdefault(frozenset(got.tolist()), key) == key
    assert len(seen) == len(set(seen.values()))
