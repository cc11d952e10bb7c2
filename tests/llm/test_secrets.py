import hashlib
import math
import random
import re
import string

import pytest

from pyspark.sql import functions as F

from deedflow.llm import secrets
from deedflow.llm import secrets as s


def base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.ASCII) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


@pytest.fixture(scope="module")
def ratios(spark):
    return s.fit(s.labelled_sample(spark))


def run(spark, texts, ratios):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    rows = s.scan(docs, ratios, ["doc_id"]).select("doc_id", s.listed(s.F.col("base")).alias("b"), s.listed(s.F.concat("base", "added")).alias("all")).collect()
    return {r.doc_id: (r.b, r.all) for r in rows}


def test_base_spans_against_re(spark, ratios):
    rnd = random.Random(1)
    bits = ["password", "PassWd", "apikey", "API_KEY", "token", "secret", '"', "'", " ", "=", ":", "=  ", "abc", "abcdef12", "=token", "AKIA", "AKIA" + "A1" * 8, "AKIA" + "Z" * 15, "0123456789abcdef" * 2, "deadbeef" * 3, "f" * 23, "é", "\U0001f600", "\n", "-", "/x.y", "K"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(800)]
    texts += [None, "", "x" * 100_000, "token=abcdef " * 300, "secret=token: abcdef123", "ſecret=abcdefgh", "api_Kеy=abcdefgh"]
    got = run(spark, texts, ratios)
    for i, t in enumerate(texts):
        assert got[i][0] == base(t), t
        assert set(filter(None, got[i][0].split(","))) <= set(got[i][1].split(","))


def test_markov_models_tell_random_strings_from_identifiers(spark, ratios):
    rnd = random.Random(5)
    keys = ["".join(rnd.choice(s.ALPHABET[:62]) for _ in range(rnd.randint(24, 48))) for _ in range(200)]
    plain = ["readSampleResponseHeaders", "database_connection_timeout_seconds", "src/module/handler/router_config", "internationalisation-settings", "MAXIMUM_BUFFER_SIZE_PER_WORKER", "thonblehetherandingstion", "geschwindigkeitsbegrenzung", "antikonstitutionellement"]
    got = run(spark, [f"see {k} here" for k in keys + plain], ratios)
    found = ["markov" in got[i][1] for i in range(len(keys) + len(plain))]
    assert sum(found[: len(keys)]) >= 0.97 * len(keys)
    assert not any(found[len(keys) :])
    hit = next(i for i in range(len(keys)) if found[i])
    assert got[hit][1] == f"markov:4:{4 + len(keys[hit])}"


def test_keys_joined_to_words_are_found(spark, ratios):
    rnd = random.Random(6)
    words = lambda n, by: by.join(rnd.choice(s.WORDS) for _ in range(n))
    key = lambda n: "".join(rnd.choice(s.ALPHABET[:62]) for _ in range(n))
    cases = []
    for i in range(200):
        before, after = (words(2 + i % 12, "/") + "/", words(3, "_") + "_value=", "", words(4, "-") + "-")[i % 4], ("", "/" + words(3, "/"), "_" + words(6, "_"))[i % 3]
        cases.append((before, key(24 + i % 9), after))
    got = run(spark, ["see " + "".join(c) + " here" for c in cases], ratios)
    spans = [[tuple(map(int, x.split(":")[1:])) for x in got[i][1].split(",") if "markov" in x] for i in range(len(cases))]
    whole = [any(a <= 4 + len(b) and 4 + len(b) + len(k) <= e for a, e in spans[i]) for i, (b, k, _) in enumerate(cases)]
    assert sum(whole) >= 0.97 * len(cases)
    # a span may take in a neighbouring word, not the run
    assert sum(e - a for x in spans for a, e in x) <= 1.3 * sum(len(k) for _, k, _ in cases)
    two = key(30), key(30)
    assert run(spark, [f"{two[0]}/module/handler/response/{two[1]}"], ratios)[0][1].count("markov") == 2


def test_short_keys_and_upper_case_hex(spark, ratios):
    rnd = random.Random(8)
    draw = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    groups = {n: [draw(s.ALPHABET[:62], n) for _ in range(100)] for n in (12, 16, 19)} | {n: [draw("0123456789ABCDEF", n) for _ in range(100)] for n in (20, 32)}
    plain = ["HTTPServerConnectionFactory", "2024-01-15T10-11-12", "IMG_20240115_101112", "user_id_1234567890", "4111111111111111", "org/apache/spark/sql/catalyst", "ThreadPoolExecutor"]
    texts = [k for g in groups.values() for k in g] + plain
    got = run(spark, [f"see {k} here" for k in texts], ratios)
    found = ["markov" in got[i][1] for i in range(len(texts))]
    shares = {n: sum(found[100 * i : 100 * i + 100]) for i, n in enumerate(groups)}
    assert all(shares[n] >= least for n, least in {12: 50, 16: 80, 19: 90, 20: 88, 32: 95}.items()), shares
    assert not any(found[500:])


def test_query_columns_and_empty_table(spark, ratios, tmp_path):
    spark.createDataFrame([(1, None), (2, "password=hunter22x"), (2, "password=hunter22x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(map(tuple, s.op9_secret_scan(spark, str(tmp_path)).collect()))
    none = (1, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert rows == [none, *[(2, 1, 0, 0, hashlib.sha256(b"assign:0:18").hexdigest(), "assign:0:18")] * 2]
    assert run(spark, [], ratios) == {}


def walked(text, ratios):
    """markov spans, one character at a time."""
    out = []
    for m in re.finditer(secrets.CANDIDATE, text):
        s = m[0]
        code = [secrets.ALPHABET.find(c) + 1 for c in s]
        parts, total, start, peak, end = [], 0.0, 0, 0.0, 0

        def close():
            plain = re.match(secrets.PLAIN, s[start : end + 1])
            most, each = (secrets.PLAIN_THRESHOLD, secrets.PLAIN_MARGIN) if plain else (secrets.THRESHOLD, secrets.MARGIN)
            if peak >= max(most, secrets.THRESHOLD) and peak >= max(each, secrets.MARGIN) * (end - start):
                parts.append((start, end))

        for at, (a, b) in enumerate(zip(code, code[1:]), 1):
            total += round(ratios[a * secrets.WIDE + b], 5)
            if total <= 0 or total < peak - secrets.DROP:
                close()
                total, start, peak, end = 0.0, at, 0.0, at
            elif total > peak:
                peak, end = total, at
        close()
        spans = []
        for a, b in parts:
            a, b = a - len(re.search("[A-Za-z0-9]*$", s[:a])[0]), b + 1 + len(re.match("[A-Za-z0-9]*", s[b + 1 :])[0])
            if spans and a <= spans[-1][1]:
                a, b = spans[-1][0], max(b, spans.pop()[1])
            spans.append((a, b))
        out += [(m.start() + a, m.start() + b) for a, b in spans]
    return out


def test_models_against_counting_one_by_one(spark, ratios):
    rows = [(r.text, r.secret) for r in secrets.labelled_sample(spark).collect()]
    for label in (True, False):
        assert sum(s == label for _, s in rows) == 3000
    counts = {}
    for t, s in rows:
        for a, b in zip(t, t[1:]):
            k = (s, secrets.ALPHABET.find(a) + 1, secrets.ALPHABET.find(b) + 1)
            counts[k] = counts.get(k, 0) + 1
    totals = {(s, a): sum(counts.get((s, a, b), 0) + 1 for b in range(secrets.WIDE)) for s in (True, False) for a in range(secrets.WIDE)}
    for a in range(secrets.WIDE):
        for b in range(secrets.WIDE):
            p, q = ((counts.get((s, a, b), 0) + 1) / totals[s, a] for s in (True, False))
            assert abs(math.log(p / q) - ratios[a * secrets.WIDE + b]) < 1e-9


def test_spans_against_a_walk_and_held_out_rates(spark, ratios):
    rnd = random.Random(9)
    key = lambda n, alphabet=string.ascii_letters + string.digits: "".join(rnd.choice(alphabet) for _ in range(n))
    held = "harbour meadow candle orchard violin pencil garden copper winter saddle thunder pocket ribbon castle lantern marble".split()
    name = lambda: rnd.choice("_-/").join(rnd.choice(held) for _ in range(rnd.randint(2, 5)))
    keys, names = [key(rnd.randint(20, 40)) for _ in range(400)], [name() for _ in range(400)]
    texts = [*keys, *names, *(f"{name()}_{key(24)} {name()}/{key(8)}={name()}" for _ in range(200)), "", "é" * 30, key(3000), " ".join(keys), "A" * 500]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", secrets.markov_spans(F.col("t"), ratios).alias("s")).collect()
    found = {r.i: [(s.start, s.end) for s in r.s] for r in got}
    assert all(found[i] == walked(t, ratios) for i, t in enumerate(texts))
    assert sum(bool(found[i]) for i in range(400)) >= 0.9 * 400
    assert sum(bool(found[i]) for i in range(400, 800)) <= 0.02 * 400
    print("recall", sum(bool(found[i]) for i in range(400)) / 400, "false", sum(bool(found[i]) for i in range(400, 800)) / 400)


def test_prose_and_identifiers_of_held_out_words_are_left_alone(spark, ratios):
    rnd = random.Random(11)
    held = "harbour meadow candle orchard violin pencil garden copper winter saddle thunder verein freiheit gesundheit porque siempre fenetre lumiere ouverture naturaleza przyjaciel zelfstandig".split()
    glued = ["thononthwhwh", "laouoieuxaux", "Queosjaquell", "Donaudampfschifffahrt", "antidisestablishmentarianism", "zhwthqkvwx-qzjkwthvv"]
    glued += ["".join(rnd.choice(held) for _ in range(rnd.randint(2, 6))) for _ in range(200)]
    glued += ["".join(rnd.choice(["eau", "tion", "sch", "qu", "wh", "th", "ieux", "ll", "ing", "ca", "zz", "kt", "y"]) for _ in range(rnd.randint(5, 12))).title() for _ in range(200)]
    named = [f"{rnd.choice('_-/').join(rnd.choice(held) for _ in range(3))}{rnd.choice(['', '_v2', '2024', '/17', '.txt'])}" for _ in range(200)]
    got = run(spark, glued + named + [" ".join(glued)], ratios)
    assert [t for i, t in enumerate(glued + named) if got[i][1]] == [] and got[len(glued + named)][1] == ""


def test_recall_of_each_alphabet_from_16_characters(spark, ratios):
    rnd = random.Random(12)
    numerals = string.digits
    alphabets = (s.ALPHABET[:62], s.ALPHABET[:64], s.ALPHABET[26:62], s.ALPHABET[:26] + numerals, s.ALPHABET[:6] + numerals)
    keys = [("".join(rnd.choice(a) for _ in range(n)), k, n) for k, a in enumerate(alphabets) for n in (16, 24, 32) for _ in range(200)]
    got = run(spark, [f"x {k} y" for k, _, _ in keys], ratios)
    for k in range(len(alphabets)):
        for n, least in ((16, 0.85), (24, 0.95), (32, 0.97)):
            mine = [bool(got[i][1]) for i, (_, a, m) in enumerate(keys) if (a, m) == (k, n)]
            assert sum(mine) >= least * len(mine), (k, n, sum(mine))


def test_many_candidates_marks_and_overlaps(spark, ratios):
    rnd = random.Random(13)
    key = lambda n: "".join(rnd.choice(s.ALPHABET[:62]) for _ in range(n))
    many = " ".join(key(24) if i % 10 == 0 else f"candidate{i:07d}abc" for i in range(30_000))
    odd = f"\ue000 \ue000{key(30)}\ue000 token={key(30)} \ue000 {key(30)}"
    both = " ".join(f"password={key(20)} {key(28)} {'0123456789abcdef' * 2}" for _ in range(3000))
    texts = [many, odd, both]
    got = run(spark, texts, ratios)
    for i, t in enumerate(texts):
        assert got[i][0] == base(t)
        taken = [tuple(map(int, x.split(":")[1:])) for x in got[i][0].split(",") if x]
        busy = {p for a, b in taken for p in range(a, b)}
        want = [(a, b) for a, b in walked(t, ratios) if not busy.intersection(range(a, b))]
        assert [tuple(map(int, x.split(":")[1:])) for x in got[i][1].split(",") if x.startswith("markov")] == want
