import hashlib
import math
import random
import re
import zlib
from collections import Counter

from deedflow.llm import resample as r


def feats(text, longest):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1)]


def brute(docs, target, percent, floor, seed, longest, width):
    bucket = lambda f: zlib.crc32(f.encode()) % width
    s = Counter(bucket(f) for _, text in docs for f in feats(text, longest)[1])
    t = Counter(bucket(f) for text in target for f in feats(text, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + width) / ((s[b] + 1) * (big_t + width)))) for b in s}
    rows = []
    for key, text in docs:
        n_words, f = feats(text, longest)
        weight = sum(gain[bucket(x)] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((x for x in rows if x[4] >= floor), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {id(x): i for i, x in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted([(*x[:4], rank.get(id(x))) for x in rows], key=str)


def run(spark, docs, target, percent=30, floor=5, seed=7, longest=1, width=50):
    a = spark.createDataFrame([(*x, "x", 1, 2) for x in docs], "doc_id long, text string, bucket string, gain int, rank int").repartition(4)
    b = spark.createDataFrame([(x, 3) for x in target], "text string, doc_id int")
    got = r.resample(a, b, percent=percent, min_words=floor, seed=seed, longest=longest, width=width)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(x) for x in got.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"W{i}é" for i in range(60)] + ["Ä", "ä", "x9"]
    some = lambda n: rnd.choice([" ", ", ", "-"]).join(rnd.choice(words) for _ in range(n))
    docs = [(i, some(rnd.randint(0, 40))) for i in range(150)]
    return docs + [(None, some(12)), (200, None), (201, ""), (202, "!!"), (3, docs[3][1]), (3, docs[3][1]), (4, docs[5][1])], [some(rnd.randint(0, 20)) for _ in range(8)] + [None]


def test_against_brute_force(spark):
    docs, target = corpus(1)
    assert run(spark, docs, target) == brute(docs, target, 30, 5, 7, 1, 50)
    assert run(spark, docs, target, 100, 0, 1, 3, 977) == brute(docs, target, 100, 0, 1, 3, 977)


def test_long_texts_and_empty_tables(spark):
    docs, target = [(1, "same " * 60_000), (2, "other words of some length here"), (3, "x")], ["same words"]
    assert run(spark, docs, target, 50) == brute(docs, target, 50, 5, 7, 1, 50)
    assert run(spark, docs, [], 50) == brute(docs, [], 50, 5, 7, 1, 50)
    assert run(spark, [], target) == []


def test_ranks_of_many_partitions_and_groups(spark):
    from pyspark.sql import functions as F

    from deedflow.llm.common import ranked

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 997).alias("v"), "id")
    got = ranked(df, [F.desc("v"), F.asc("id")], ("g",)).collect()
    for g in range(3):
        mine = sorted((x for x in got if x.g == g), key=lambda x: x["rank"])
        assert [x["rank"] for x in mine] == list(range(1, len(mine) + 1))
        assert [(x.v, x.id) for x in mine] == sorted(((x.v, x.id) for x in mine), key=lambda y: (-y[0], y[1]))
