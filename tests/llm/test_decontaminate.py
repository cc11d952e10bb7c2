import random
import re

from deedflow.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, who = words(t), set(), set()
        for item, x in items:
            v = words(x)
            m = min(len(v), 10)
            windows = {tuple(v[a : a + m]) for a in range(len(v) - m + 1)} if v else set()
            for p in range(len(w) - m + 1):
                if m and tuple(w[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    who.add(item)
        who.discard(None)
        out.append((i, len(w), len(hit), len(who), sorted(map(str, who))))
    return sorted(out, key=str)


def run(spark, docs, items):
    a = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, n_words int")
    b = spark.createDataFrame([(*r, 3) for r in items], "item_id long, text string, doc_id long")
    got = [r for r in d.contamination(a, b).collect() for _ in range(r.rows)]
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in got), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    some = lambda n, v: [rnd.choice(v) for _ in range(n)]
    few, many = ["a", "b", "C"], [f"w{i}é" for i in range(300)] + ["İ", "É", "x"]
    items = [(i, some(rnd.randint(1, 45), few if i % 4 == 0 else many)) for i in range(25)]
    docs = []
    for i in range(120):
        w = some(rnd.randint(0, 60), few if i % 5 == 0 else many)
        for _ in range(rnd.randint(0, 3)):
            x = rnd.choice(items)[1]
            a = rnd.randrange(len(x))
            at = rnd.randint(0, len(w))
            w[at:at] = x[a : a + rnd.randint(1, 25)]
        docs.append((i, rnd.choice([" ", ", ", "\n-"]).join(w)))
    return docs, [(i, " ".join(x)) for i, x in items]


def test_against_brute_force(spark):
    docs, items = corpus(1)
    docs += [(1, docs[2][1]), (2, docs[2][1]), (2, docs[2][1]), (None, items[3][1]), (900, None), (901, ""), (902, "!!"), (903, "w1é " * 20_000 + items[5][1])]
    items += [(3, items[4][1]), (None, items[5][1]), (50, None), (51, "..."), (52, "Solo"), (53, "two words")]
    docs += [(904, "solo two WORDS solo"), (905, "two. words")]
    assert run(spark, docs, items) == brute(docs, items)


def test_shuffled_index_and_empty_tables(spark, monkeypatch):
    docs, items = corpus(2)
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(d, "BROADCAST_KEYS", -1)
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs[:5], []) == brute(docs[:5], [])
    assert run(spark, [], items) == []


def test_stage_keeps_clean_documents(spark):
    docs, items = corpus(3)
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {r.doc_id for r in d.decontaminate(a, b).collect()} == {r[0] for r in brute(docs, items) if not r[2]}
