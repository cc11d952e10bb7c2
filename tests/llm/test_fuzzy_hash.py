import hashlib
import random

from deedflow.llm import fuzzy_hash as h

M, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def slow_fingerprint(text):
    data = text.encode()
    size = 3
    while size * 64 < len(data):
        size *= 2
    signs = []
    for s in (size, 2 * size):
        out, total, open_ = "", 0, False
        for i in range(len(data)):
            x = 0
            for j in range(i - 6, i + 1):
                x = (x * M + (data[j] if j >= 0 else 0) + 1) & MASK
            x ^= x >> 32
            x = x * M & MASK
            x ^= x >> 29
            total, open_ = (total + x) & MASK, True
            if x % s == s - 1:
                out += chr(h.CHARACTERS[(total * M & MASK) >> 58])
                total, open_ = 0, False
        signs.append(out + (chr(h.CHARACTERS[(total * M & MASK) >> 58]) if open_ else ""))
    return f"{size}:{signs[0]}:{signs[1]}"


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghiéßж") for _ in range(rnd.randint(1, 9))) for _ in range(n))


def test_fingerprints_against_a_plain_loop(monkeypatch):
    rnd = random.Random(1)
    texts = ["", "a", "é", "aaaa" * 300, "line\n" * 400] + [prose(rnd, n) for n in (1, 3, 20, 200, 900)]
    want = [slow_fingerprint(t) for t in texts]
    assert [h.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(h, "STEP", 11)
    assert [h.fingerprint(t) for t in texts] == want
    assert h.fingerprint("") == "3::"


def test_edit_distance_against_the_table():
    rnd = random.Random(2)
    for _ in range(400):
        a, b = ("".join(rnd.choice("ABCD") for _ in range(rnd.randint(0, 90))) for _ in range(2))
        assert h.edit_distance(a, b) == slow_distance(a, b) == h.edit_distance(b, a)


def test_likeness_tells_edits_from_strangers():
    rnd = random.Random(3)
    near, far = [], []
    for n in [*range(10, 60, 5), *range(60, 1000, 60)]:
        a, b = prose(rnd, n), prose(rnd, n)
        near.append(h.likeness(h.fingerprint(a), h.fingerprint(h.edited(a, b))))
        far.append(h.likeness(h.fingerprint(a), h.fingerprint(b)))
        assert h.likeness(h.fingerprint(a), h.fingerprint(a)) == 1
        assert h.likeness(h.fingerprint(a), h.fingerprint("Say: " + a)) > 0.8
    assert min(near) > 0.25 and sum(near) / len(near) > 0.4 and max(far) < 0.1
    assert h.likeness("3::", "3:A:A") == 0 and h.likeness("3::", "3::") == 1
    assert h.likeness("3:ABCDEFG:ABC", "12:ABCDEFG:ABC") == 0  # sizes too far apart
    assert h.likeness("3:X:ABCDEFG", "6:ABCDEFG:Y") == 1


def brute(rows):
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        other = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = slow_fingerprint(text), slow_fingerprint(other), slow_fingerprint(after)
        out.append((key, len(text), hashlib.sha256(other.encode()).hexdigest(), a, b, h.likeness(a, b), h.likeness(a, c)))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, _key int").repartition(parts)
    return sorted((tuple(r) for r in h.with_next(df).collect()), key=str)


def test_order_over_partitions_against_brute_force(spark):
    rnd = random.Random(4)
    keys = rnd.sample(range(-5000, 5000), 60)
    rows = [(k, prose(rnd, rnd.randint(0, 40))) for k in keys] + [(7000, None), (7001, ""), (None, "keyless 漢字"), (8000, prose(rnd, 3000))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert run(spark, [(None, "a b c d")]) == brute([(None, "a b c d")])
    assert run(spark, []) == []


def test_repeated_rows_and_keys(spark):
    rows = [(1, "same text here")] * 5 + [(2, "another one"), (2, "a second text of the key"), (3, "last"), (None, None), (None, "x")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert sorted(r[0] for r in got if r[0] is not None) == [1] * 5 + [2, 2, 3]
    assert len({r[3] for r in got if r[0] == 1}) == 1


def test_column_functions(spark):
    df = spark.createDataFrame([("some words of a text", None), (None, "3::")], "text string, other string")
    got = df.select(h.fingerprint_of("text").alias("f"), "other").withColumn("l", h.likeness_of("f", "other")).collect()
    assert [r.f for r in got] == [h.fingerprint("some words of a text"), "3::"] and [r.l for r in got] == [None, 1.0]
