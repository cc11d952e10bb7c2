"""Language ID and PII against second implementations, written as plain loops."""

import hashlib
import ipaddress
import math
import random
import re
from datetime import date, timedelta

import numpy as np

from deedflow.llm import lang_id as m
from deedflow.llm import pii


def slow_shares(text):
    """Bucket -> share, and the number of n-grams, one n-gram at a time."""
    symbols = [c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in text.encode()]
    counts, total = {}, 0
    for n in m.ORDERS:
        for at in range(len(symbols) - n + 1):
            h = 0
            for s in symbols[at : at + n]:
                h = ((h * 0x01000193) & 0xFFFFFFFF) ^ s
            b = ((h * 0x9E3779B1) & 0xFFFFFFFF) >> 17
            counts[b] = counts.get(b, 0) + 1
            total += 1
    return {b: c / total for b, c in counts.items()}, total


def prose(rnd, letters, n):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_scores_against_plain_loops(spark):
    rnd = random.Random(1)
    letters = {"aa": "abcdeé", "bb": "efghiß", "cc": "jklmno"}
    rows = [(i, prose(rnd, letters[g], rnd.randint(3, 40)) + rnd.choice([".", " 12!", ""]), g) for i, g in enumerate(["aa", "bb", "cc"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = m.train(docs, m.F.lit(True))
    odd = [(1000, "A", None), (1001, "xyz", None), (1002, "123", None), (1003, None, None), (1004, "", None), (1005, "Äe", None)]
    got = {r.doc_id: r for r in m.predict(spark.createDataFrame(rows + odd, docs.schema), model, ["doc_id"]).collect()}
    for i, text, _ in rows + odd:
        r = got[i]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        shares, n = slow_shares(text)
        z = [model.bias[k] + sum(w * float(model.table[b, k]) for b, w in shares.items()) for k in range(3)]
        top = max(z)
        p = [math.exp(x - top) for x in z]
        p = [x / sum(p) for x in p]
        best = p.index(max(p))
        assert r.lang_pred == model.langs[best] and abs(r.score - max(p)) < 1e-4
        novel = False
        if n:
            mean = sum(w * float(model.shares[b, best]) for b, w in shares.items())
            mu, between, within = model.usual[best]
            uniform = sum(float(x) for x in model.shares[:, best]) / m.BUCKETS
            off = (mean - mu) / math.sqrt(between + within / n)
            if abs(off - model.least) < 1e-3:
                continue
            novel = off < model.least and mean < mu - m.FAR * (mu - uniform)
        assert r.rejected == (max(p) < model.reject_below or novel)


def test_gradient_steps_against_plain_loops(monkeypatch):
    monkeypatch.setattr(m, "EPOCHS", 2)
    rnd = random.Random(2)
    rows = []
    for i in range(12):
        shares, n = slow_shares(prose(rnd, "abcd" if i % 2 else "wxyz", 6))
        idx = np.array(sorted(shares), np.int32)
        rows.append(("a" if i % 2 else "b", idx, np.array([shares[b] for b in idx.tolist()], np.float32), n))
    model = m.fit(rows)
    gen = np.random.default_rng(7)
    emb = gen.uniform(-1, 1, (m.BUCKETS, m.DIM)).astype(np.float32).astype(float) / m.DIM
    out, bias, t = [[0.0] * m.DIM for _ in range(2)], [0.0, 0.0], 0
    for _ in range(2):
        for i in gen.permutation(len(rows)):
            label, idx, share, _ = rows[i]
            rate = m.RATE * (1 - t / (2 * len(rows)))
            avg = [sum(float(s) * emb[b, d] for b, s in zip(idx, share)) for d in range(m.DIM)]
            z = [bias[k] + sum(out[k][d] * avg[d] for d in range(m.DIM)) for k in range(2)]
            p = [math.exp(x - max(z)) for x in z]
            err = [x / sum(p) - (k == ("a", "b").index(label)) for k, x in enumerate(p)]
            back = [sum(err[k] * out[k][d] for k in range(2)) for d in range(m.DIM)]
            for k in range(2):
                bias[k] -= rate / 100 * err[k]
                for d in range(m.DIM):
                    out[k][d] -= rate / 8 * err[k] * avg[d]
            for b, s in zip(idx, share):
                for d in range(m.DIM):
                    emb[b, d] -= rate * float(s) * back[d]
            t += 1
    used = sorted({int(b) for _, idx, _, _ in rows for b in idx})
    assert np.allclose(model.table[used], emb[used] @ np.array(out).T, atol=2e-4) and np.allclose(model.bias, bias, atol=1e-4)
    loss = lambda t, z, y: sum(-sum(g * math.log(math.exp(x / t) / sum(math.exp(v / t) for v in row)) for g, x in zip([(len(y) + 1) / (len(y) + 2) if k == c else 1 / (len(y) + 2) / (len(row) - 1) for k in range(len(row))], row)) for row, c in zip(z, y))
    z, y = [[2.0, 0.1], [0.3, 1.0], [1.5, 1.4]], [0, 1, 1]
    best = m.temperature(np.array(z), np.array(y))
    assert all(loss(best, z, y) <= loss(t, z, y) + 1e-9 for t in np.geomspace(1e-2, 1e2, 60))


class Second:
    """The permutation once more: rounds of modular addition by the digest of (tweak, round, other half)."""

    def __init__(self, key):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def digest(self, tweak, i, half):
        return int.from_bytes(hashlib.blake2b(f"{tweak}|{i}|{half}".encode(), key=self.key, digest_size=64).digest(), "big")

    def pair(self, x, y, a, b, tweak):
        for i in range(pii.ROUNDS):
            if i % 2:
                y = (y + self.digest(tweak, i, x)) % b
            else:
                x = (x + self.digest(tweak, i, y)) % a
        return x, y


def test_permutation_against_a_second_one():
    a, b = pii.Feistel(b"k"), Second(b"k")
    for x, y, p, q in ((0, 0, 10, 10), (3, 7, 11, 13), (123456, 999, 10**9, 10**7), (0, 0, 1, 5)):
        assert a.pair(x, y, p, q, "t") == b.pair(x, y, p, q, "t")
        assert a.pair(*a.pair(x, y, p, q, "t"), p, q, "t", back=True) == (x, y)
    for n in (1, 2, 7, 60, 1000):
        assert sorted(a.index(i, n, "z") for i in range(n)) == list(range(n))


def valid(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
    if kind == "ip":
        return bool(ipaddress.IPv4Address(text))
    if kind == "iban":
        flat = text.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    if kind == "ssn":
        a, b, c = text.split("-")
        return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    return True


def test_values_in_texts_against_a_second_scanner(spark):
    """Each value stands alone among words, so that splitting at blanks finds it; formats and check digits are tested anew."""
    rnd = random.Random(4)
    day = lambda: (date(1900, 1, 1) + timedelta(rnd.randrange(70_000))).isoformat()

    def card():
        d = [4] + [rnd.randrange(10) for _ in range(14)]
        total = sum(sum(divmod(2 * x, 10)) if i % 2 == 0 else x for i, x in enumerate(reversed(d)))
        return "".join(map(str, d)) + str(-total % 10)

    values = [("card", card()) for _ in range(40)] + [("ip", f"{rnd.randrange(1, 256)}.{rnd.randrange(256)}.7.{rnd.randrange(256)}") for _ in range(40)] + [("date", day()) for _ in range(40)]
    values += [("ssn", f"{rnd.randrange(100, 600)}-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)}") for _ in range(40)] + [("iban", "GB82WEST12345698765432"), ("iban", "DE89370400440532013000")]
    texts = [" ".join(x for _, v in (rnd.sample(values, 5)) for x in ("word", v, "and")) for _ in range(60)] + ["1234567890123456 300.1.1.1 2001-13-01 000-12-3456 nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.protect(docs, b"k", counts=False).collect()}
    kinds, seen = dict((v, k) for k, v in values), {}
    for i, t in enumerate(texts):
        before, after = t.split(" "), got[i].split(" ")
        assert len(before) == len(after)
        for x, y in zip(before, after):
            if x in kinds:
                assert re.sub("[0-9]", "9", x) == re.sub("[0-9]", "9", y) or kinds[x] in ("ip", "iban"), (x, y)
                assert valid(kinds[x], y) and seen.setdefault(x, y) == y
            else:
                assert x == y
    assert len(set(seen.values())) == len(seen) and sum(x != y for x, y in seen.items()) > 0.95 * len(seen)
    early = {x: pii.calendar(pii.Feistel(b"k"), x) for x in ("0001-01-01", "1899-12-31", "2100-01-01", "9999-12-31")}
    assert all(date.fromisoformat(y).year < 1900 if x < "1900" else date.fromisoformat(y).year > 2099 for x, y in early.items())
    assert all(pii.calendar(pii.Feistel(b"k"), y, back=True) == x for x, y in early.items())
