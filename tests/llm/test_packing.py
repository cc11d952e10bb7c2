import random
from collections import Counter

from deedflow.llm.packing import best_fit, op2_packing, pack
from tests.llm.test_jaccard_join import brute as brute_groups


def brute(sizes, sources, clusters, capacity):
    bins, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= sizes[i] and sources[i] not in b[1] and clusters[i] not in b[2]]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        out[i] = (k, capacity - bins[k][0])
        bins[k][0] -= sizes[i]
        bins[k][1].add(sources[i])
        bins[k][2].add(clusters[i])
    return [out[i] for i in range(len(sizes))]


def test_tightest_compatible_bin():
    rnd = random.Random(2)
    for _ in range(60):
        n = rnd.randint(0, 60)
        args = [rnd.randint(1, 100) for _ in range(n)], [rnd.choice("aaabcdef") for _ in range(n)], [rnd.randint(0, 30) for _ in range(n)]
        assert best_fit(*args, 100) == brute(*args, 100)


def test_repeated_rows_are_dealt_to_several_tasks(spark):
    docs = spark.range(900).selectExpr("cast(1 as long) as doc_id", "'same few words' as text", "'s' as source")
    got = pack(docs, per_task=100).collect()
    assert len({r.bin_id for r in got}) == len(got) == 900
    tasks = [r.bin_id >> 40 for r in got]
    assert max(tasks.count(t) for t in set(tasks)) < 450


def test_whole_texts_and_conflicts(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join("w%d" % rnd.randint(0, 50) for _ in range(rnd.randint(1, 90))), f"s{rnd.randint(0, 9)}") for i in range(300)]
    rows += [(500 + i, "The SAME words", "hot") for i in range(100)] + [(700, None, "a"), (701, "", "a"), (702, " \n", None), (703, "long " * 250, "a"), (703, "long " * 250, "a"), (None, "x", None), (704, "x" * 100_000, "b")]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, source string, piece string, n_words int")
    got = pack(docs, capacity=100, per_task=100).collect()
    words = {}
    for i, t, s in rows:
        words.setdefault(i, []).append((len((t or "").split()), s, (t or "").lower().split()))
    assert {r.doc_id for r in got} == set(words)
    total, seen = {}, {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        if r.bin_id is None:
            assert r.length == 0
            continue
        seen.setdefault(r.bin_id, []).append(r)
    assert total == {i: sum(n for n, *_ in v) for i, v in words.items()}
    for rs in seen.values():
        rs.sort(key=lambda r: r.offset)
        assert all(a.offset + a.length == b.offset for a, b in zip(rs, rs[1:])) and rs[0].offset == 0 and rs[-1].offset + rs[-1].length <= 100
        sources = [words[r.doc_id][0][1] for r in rs]
        texts = [" ".join(words[r.doc_id][0][2]) for r in rs]
        assert len(set(sources)) == len(sources) and len(set(texts)) == len(texts)
    assert pack(docs.limit(0)).collect() == []
    again = pack(docs, capacity=100, per_task=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_near_copies_never_share_a_bin(spark, tmp_path):
    rnd = random.Random(7)
    word = lambda: "w%d" % rnd.randint(0, 400)
    rows = []
    for i in range(40):
        text = [word() for _ in range(60)]
        for j in range(5):  # a chain: each a near copy of the one before
            rows.append((5 * i + j, " ".join(text), f"s{5 * i + j}"))
            text = text[:-2] + [word(), word()] if j % 2 else [word(), word()] + text[2:]
    rows += [(900, None, "n"), (901, "", "m"), (902, "one two", "k"), (903, "ONE two", "l"), (None, rows[0][1], "z")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op2_packing(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    groups = {d: c for d, _, c in brute_groups([(d, t) for d, t, _ in rows if d is not None], 5, 80)} | {None: 0}
    assert len(set(groups.values())) < len(rows) - 100
    bins = {}
    for r in got:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(groups[r.doc_id])
    assert all(len(set(b)) == len(b) for b in bins.values())
    assert max(map(len, bins.values())) > 20
