import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedflow.llm import topk


def brute(vectors, k, scale=64):
    ok = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, set()).add(tuple(math.floor(scale * x) for x in v))
    out = []
    for q, qs in ok.items():
        if q % 3 == 0:
            for qv in qs:
                got = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, vs in ok.items() for v in vs if i != q and len(v) == len(qv))[:k]
                out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, score int, dims string")


def run(spark, rows, k):
    return sorted(map(tuple, topk.top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, k).collect()))


def test_against_brute_force_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 150)
    monkeypatch.setattr(topk, "QUERIES", 40)
    monkeypatch.setattr(topk, "FIRST", 25)
    monkeypatch.setattr(topk, "SLAB", 16)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(size=12) * 0.2]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(5, rows[5][1]), (None, rows[1][1]), (2000, None), (2001, [None, 1.0]), (2003, [float("nan")] * 12), (2004, [float("inf")] * 12), (2006, [1.0, 2.0]), (2007, [0.5, -2.0]), (2010, [0.0] * 12)]
    assert run(spark, rows, 7) == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 7)


def test_small_and_empty_tables(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(3, [1.0])], 3) == []
    assert run(spark, [(3, [1.0]), (4, [1.0])], 3) == [(3, 1, 4, 4096)]


@pytest.mark.parametrize("size", [1, 30, 1 << 22])
def test_stops_only_on_proof(size):
    rnd = np.random.default_rng(size)
    c = np.floor(rnd.normal(size=(900, 16)) ** 3 * size).astype(np.int64)
    q = c[:40]
    ids = rnd.permutation(900)
    for place, got, score in topk.search(ids, topk.Index(c), ids[:40], q, 10):
        exact = sorted((-int(s), int(i)) for s, i in zip(c @ q[place], ids) if i != ids[place])[:10]
        assert [(-int(s), int(i)) for s, i in zip(score, got)] == exact


@pytest.mark.parametrize("size", [1, 30, 1 << 22])
def test_floors_lose_no_member(size):
    rnd = np.random.default_rng(size + 1)
    c = np.floor(rnd.normal(size=(1200, 16)) ** 3 * size).astype(np.int64)
    c[600:] //= 4  # the later block is mostly below the floors
    ids = rnd.permutation(1200)
    floors = np.full(40, topk.NO_FLOOR)
    for place, _, score in topk.search(ids[:600], topk.Index(c[:600]), ids[:40], c[:40], 10):
        floors[place] = score[-1]
    got = dict((p, (i, s)) for p, i, s in topk.search(ids[600:], topk.Index(c[600:]), ids[:40], c[:40], 10, floors))
    for place in range(40):
        exact = sorted((-int(s), int(i)) for s, i in zip(c[600:] @ c[place], ids[600:]) if s >= floors[place])[:10]
        assert [(-int(s), int(i)) for i, s in zip(*got.get(place, ((), ())))] == exact


def test_few_candidates_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 4)
    rows = [(i, [float(2**22 * (i % 5)), float(i)]) for i in range(18)] + [(40, [0.0, 0.0])] * 2
    assert run(spark, rows, 5) == brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 5)


def test_queries_are_not_sent_to_blocks_out_of_reach(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=8) * 0.05 * 1.01 ** (i % 400)]) for i in range(1200)]
    sent = []
    to_blocks = topk.to_blocks

    def counting(asked, levels, start, stop):
        out = to_blocks(asked, levels, start, stop)
        sent.append((out.count(), asked.count() * (stop - start), out.select("cb").distinct().count()))
        return out

    monkeypatch.setattr(topk, "to_blocks", counting)
    got = run(spark, rows, 5)
    assert got == brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 5)
    assert sent[0][0] == sent[0][1]  # the first block is searched by all
    assert 0 < sent[1][0] < 0.6 * sent[1][1], sent
    # equal norms can't be told apart: all are sent
    sent.clear()
    same = [(i, [1.0 if j == i % 8 else 0.0 for j in range(8)]) for i in range(300)]
    assert run(spark, same, 5) == brute(same, 5)
    assert sent[1][0] == sent[1][1]


def test_levels_hold_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 10)
    rows = spark.range(500).select("id", F.when(F.col("id") < 300, 7.0).otherwise(F.col("id").cast("double")).alias("norm"))
    got, levels = topk.in_blocks(rows)
    by = got.groupBy("cb").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()
    assert sum(r.n for r in by) == 500 and levels[0].first == 0 and all(a.last == b.first and a.norm > b.norm for a, b in zip(levels, levels[1:]))
    for r in by:
        level = next(v for v in levels if v.first <= r.cb < v.last)
        assert r.top <= level.norm
