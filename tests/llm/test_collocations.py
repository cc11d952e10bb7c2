import random
import re
from collections import Counter

from deedflow.llm import collocations as c


def lower(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def brute(rows, floor, longest, top, cover):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    some = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= floor}
    out = []
    for (lang, w), a in some.items():
        within = [b for (lang2, v), b in some.items() if lang2 == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= cover * a for b in within):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, total, -score))
    return ranked


def run(spark, rows, floor=4, longest=4, top=10, cover=80):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "text string, lang string, gram string, f int, m int").repartition(5)
    got = c.collocations(docs, floor=floor, longest=longest, top=top, cover=cover)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, docs=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "é", "Zoë", "İ", "ß", "\x00x", "naïve gap"]
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 7))) for _ in range(12)]
    rows = []
    for _ in range(docs):
        parts = [rnd.choice(lines) if rnd.random() < 0.5 else rnd.choice([" ", "  ", "\t"]).join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 6))]
        rows.append((rnd.choice([". ", ",", "\n", "!?", "\x0b"]).join(parts), rnd.choice(["en", "en", "de", None, "und"])))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1) + [(None, "en"), ("", None), ("...", "de"), ("A b. a B", "fr")] * 4
    assert run(spark, rows) == sorted(brute(rows, 4, 4, 10, 80))


def test_lengths_cover_and_ties(spark):
    rows = corpus(2, 30)
    assert run(spark, rows, 2, 3, 1000, 100) == sorted(brute(rows, 2, 3, 1000, 100))
    assert run(spark, rows, 3, 2, 1000, 1) == sorted(brute(rows, 3, 2, 1000, 1))


def test_a_full_filter_and_small_batches_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(c, "MOST_BITS", 64)
    monkeypatch.setattr(c, "BATCH_WORDS", 5)
    assert run(spark, rows) == sorted(brute(rows, 4, 4, 10, 80))


def test_long_texts_repeated_pieces_and_empty_tables(spark):
    rows = [("one two three four " * 30_000, "en"), ("hot line here. " * 50_000, "en"), ("a b", "xx")]
    got = run(spark, rows, 30)
    assert got == sorted(brute(rows, 30, 4, 10, 80))
    assert run(spark, []) == []
    assert run(spark, [(None, None)]) == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    grams = spark.createDataFrame([("en", "a", 3 * big // 2, 1), ("en", "b", big, 1), ("en", "a b", big - 1, 2)], "lang string, gram string, f long, size int")
    assert [tuple(r) for r in c.scored(grams).collect()] == [("en", "a b", big - 1, 2, 2_000_000 * (big - 1) // (3 * big // 2 + big), 1, 3 * big // 2, big)]
