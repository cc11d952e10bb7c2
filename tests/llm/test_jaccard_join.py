import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedflow.llm import jaccard_join as j
from deedflow.llm.components import components


def words(text):
    out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(spark, rows, k=4, percent=85):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, n int, node string")
    return sorted(map(tuple, j.jaccard_components(docs, k, percent).collect()), key=str)


def corpus(seed, n=130):
    rnd = random.Random(seed)
    text = lambda n: [f"w{rnd.randint(0, 400)}" for _ in range(n)]
    rows, shared = [], text(60)
    for i in range(n // 5):
        rows.append(text(rnd.randint(1, 120)))
    base = text(90)
    for _ in range(n // 2):  # near copies: many of them are linked only through others
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 50)}"
        rows.append(w)
    for _ in range(n // 5):  # a shared passage links nothing
        rows.append(shared + text(rnd.randint(5, 80)))
    rows += [list(rows[0]), [w.upper() for w in rows[0]], ["a"], ["A"], ["a", "b"], ["é"], ["É"]]
    rnd.shuffle(rows)
    return [(1000 - i, rnd.choice([" ", "\n", " \t "]).join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize(("seed", "hubs", "percent", "k"), [(1, 2, 85, 4), (2, 12, 85, 4), (3, 1, 80, 5)])
def test_components_against_brute_force(spark, monkeypatch, seed, hubs, percent, k):
    monkeypatch.setattr(j, "HUBS", hubs)
    monkeypatch.setattr(j, "BLOCK", 8)
    rows = corpus(seed)
    assert run(spark, rows, k, percent) == brute(rows, k, percent)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_BYTES", -1)
    rows = corpus(5, 60)
    assert run(spark, rows) == brute(rows, 4, 85)


def test_odd_rows(spark):
    long = " ".join(f"z{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"), (6, "a b"), (7, long), (9, long + " end"), (8, "x" * 100_000), (None, "alone here"), (None, None), (6, "other words of one id here")]
    assert run(spark, rows) == brute(rows, 4, 85)
    assert run(spark, []) == []


def test_threshold_is_met_exactly(spark):
    # 17 of 20 shingles: 85 % of the union exactly
    a = [f"p{i}" for i in range(23)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:20])), (3, " ".join(a[:19]))]
    assert run(spark, rows) == brute(rows, 4, 85)
    assert [r[2] for r in run(spark, rows[:2])] == [1, 1]
    assert [r[2] for r in run(spark, [rows[0], rows[2]])] == [1, 3]


def test_chain_of_links(spark):
    edges = spark.range(1, 40).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v")).union(spark.range(100, 101).select("id", (F.col("id") + 900)))
    assert sorted((r.node, r.comp) for r in components(edges).collect()) == [(i, 0) for i in range(40)] + [(100, 100), (1000, 100)]
    assert components(edges.where("u < 0")).collect() == []


def test_answers_are_derived_and_one_link_joins_two_components():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.where(rnd.random(60) < 0.12, rnd.integers(0, 1 << 62, 60).astype(np.uint64), base)) for _ in range(300)]
    sets += [np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 80)).astype(np.uint64)) for _ in range(40)]
    overlaps = j.Overlaps(sets)
    for s in sets:
        assert overlaps.of(s).tolist() == [len(np.intersect1d(s, t)) for t in sets]
    assert 1 < len(overlaps.hubs) <= 8
    comp, places = np.arange(len(sets)) * 7, np.arange(len(sets))
    alike = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    for rows, columns in ((places, places), (places[:170], places[170:])):
        links = j.spanning_links(sets, comp, rows, columns, 80)
        assert all(alike(a, b) for a, b in links) and len(links) < len(sets)
        up = {i: i for i in places.tolist()}

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in links:
            assert root(a) != root(b)
            up[root(a)] = root(b)
        assert all(root(a) == root(b) for a in rows.tolist() for b in columns.tolist() if alike(a, b))


def near_group(n, words, seed):
    """n near copies of one text, each with its own words in a few places: few pairs are similar, and all share shingles."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(1, 2)):
            w[rnd.randrange(words)] = f"own{rnd.randint(0, n)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("percent", "k"), [(80, 5), (85, 4)])
def test_a_large_group_of_near_copies(spark, monkeypatch, percent, k):
    monkeypatch.setattr(j, "BLOCK", 150)
    rows = near_group(400, 56, percent)
    assert run(spark, rows, k, percent) == brute(rows, k, percent)


def test_parity_bitmaps_bound_the_symmetric_difference():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, n)).astype(np.uint64)) for n in (5, 900, 1100, 3000, 9000, 2, 4000)] + [np.zeros(0, np.uint64)]
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    bits = j.parity(doc, np.concatenate(sets), len(sets))
    for a, x in zip(bits, sets, strict=True):
        for b, y in zip(bits, sets, strict=True):
            w = min(len(a), len(b))
            far = int(np.bitwise_count(j.folded([a], w) ^ j.folded([b], w)).sum())
            assert far <= len(np.setxor1d(x, y)) and (far > 0 or len(x) == len(y) or not far)
            assert (len(np.setxor1d(x, y)) - far) % 2 == 0


def test_blocks_without_room_are_skipped_and_stars_stay_whole(spark):
    rnd = random.Random(21)
    rows, nodes = [], {}
    for token in range(6):
        list_ = sorted((rnd.randint(0, 30), rnd.randint(31, 400), rnd.getrandbits(60)) for _ in range(200))
        nodes[token] = list_
        for at in range(0, len(list_), 8):
            part = list_[at : at + 8]
            rows.append((token, part[0][0], min(s for _, s, _ in part), max(s for _, s, _ in part), [x for _, _, x in part], [s for _, s, _ in part], [p for p, _, _ in part]))
    lists = spark.createDataFrame(rows, j.LISTS)
    met, every = j.hubs_and_blocks(lists, 80).count(), 6 * j.HUBS * 25
    assert 0 < met < 0.9 * every
    flat = [(x, s, p, h) for r in j.postings(lists).withColumn("h", j.F.xxhash64("node", j.F.lit(23))).collect() for x, s, p, h in [(r.node, r["size"], r.pos, r.h)]]
    rank = {x: h for x, _, _, h in flat}
    want = set()
    for list_ in nodes.values():
        order = sorted(list_, key=lambda e: (rank[e[2]], e[2]))
        for q, m, x in order[: j.HUBS]:
            for p, s, y in list_:
                if (rank[y], y) > (rank[x], x) and 100 * min(s, m) >= 80 * max(s, m) and 180 * min(s - p, m - q) >= 80 * (s + m):
                    want.add((x, y))
    assert {tuple(r) for r in j.stars(lists, 80).collect()} == want


def test_sketches_add_up_in_a_tree(spark, monkeypatch):
    import zlib

    import numpy as np

    monkeypatch.setattr(j, "FAN", 3)
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 5, (20, 2, 16)).astype(np.uint32)
    rows = [(c, zlib.compress(counts[t, c].tobytes())) for t in range(20) for c in range(2)]
    got = j.gathered(spark.createDataFrame(rows, "chunk int, sketch binary"), 4).collect()
    assert len(got) < 20
    for c in range(2):
        total = sum(np.frombuffer(zlib.decompress(r.sketch), np.uint32).astype(int) for r in got if r.chunk == c)
        assert (total == counts[:, c].sum(axis=0)).all()
