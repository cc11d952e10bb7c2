r"""Secret scans: base patterns, and character Markov models of random strings and ordinary identifiers.

Three base patterns (assignments, access keys, hex runs) are matched leftmost and non-overlapping, each kind by
itself, and matches that are too short are dropped afterwards. The method adds `markov` spans: candidate strings of
CANDIDATE have parts that are likelier under a Markov model of random strings than under one of ordinary identifiers:
a running sum of the transitions' log-likelihood ratios starts again where it would fall under 0, and the part up to
its peak is a span, where it reaches THRESHOLD and MARGIN per transition, once the sum has fallen DROP from the peak
(or the candidate ends); it goes on to the ends of the letters and digits around it. So words before or after a key don't average it away. A span must overlap no base span. Both models
are character bigram counts (add-one smoothed) over a labelled sample; counting and scoring are DataFrame
operations, and the fitted table has alphabet-squared cells, whatever the corpus.

Digits alone, of any length, aren't spans: pairs of characters don't tell random digits from ordinary numbers.

Letters of one case alone are held to a higher bar (PLAIN), since prose of any language is made of them. A part that overlaps
a base span, wholly or in part, is left to that span. Long texts are scanned whole, in time linear in the text and the number of its matches.

Positions are code points.

Defined results: a null text is empty; texts without spans give zero counts, the hash of nothing and an empty list;
every row gives a row.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the maximal runs of [0-9a-f]+ that are long enough: shorter ones are dropped anyway
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
WIDE = len(ALPHABET) + 1  # 0: any other character
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"  # shorter ones hardly reach THRESHOLD
THRESHOLD, MARGIN, DROP = 10.5, 0.6, 6.0
#: Letters of one case (or with a capital first) and then a number, between symbols, are what words look like in any language: a part of
#: nothing else must be this much likelier under the model of random strings, in all and per transition.
PLAIN = r"^(?:[A-Z]?[a-z]*|[A-Z]*)[0-9]*(?:[+/_=-]+(?:[A-Z]?[a-z]*|[A-Z]*)[0-9]*)*$"
PLAIN_THRESHOLD, PLAIN_MARGIN = 40.0, 1.2
#: A character that is in no pattern; texts that have it get another such character in its place while positions are found.
MARK = "\ue000"
SPANS = "array<struct<kind:int,start:int,end:int,match:string>>"


def chars(text: Column) -> Column:
    return F.split(text, "")


def starts(text: Column, pattern: str) -> Column:
    """Where the leftmost non-overlapping matches begin: a mark is put before each, and the marks' places in the text's
    characters, less the marks before them, are the places. All of it is linear in the text, whatever the number of matches."""
    clean = F.translate(text, MARK, "\ufffd")
    marked = F.regexp_replace(clean, f"({pattern})", f"{MARK}$1")
    at = F.filter(F.transform(chars(marked), lambda c, i: F.when(c == MARK, i)), lambda i: i.isNotNull())
    return F.transform(at, lambda i, k: i - k)


def found(text: Column, pattern: str, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches, in order."""

    def span(m, start):
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"))

    return F.when(text.rlike(pattern), F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), starts(text, pattern), span)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    assign = F.filter(found(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    access = F.filter(found(text, ACCESS, 1), lambda s: F.length(s["match"]) >= 20)
    return F.concat(assign, access, found(text, HEX, 2))


# --- the models -----------------------------------------------------------------------------------------------

#: Words that identifiers, paths and file names are made of in the default labelled sample.
WORDS = (
    "access account action active add address admin agent alert alias allow analysis apply archive array asset attach audit author backup balance base batch begin binary block board border branch "
    "bucket buffer build button cache call cancel capture card case catalog change channel check child class clean client cluster code collect color column command comment commit compare config "
    "connect console container content context control convert copy core count create cursor custom data database date debug default delete deploy detail device digest direct display document "
    "domain download driver edit element email enable encode engine entry error event example execute export factory feature fetch field file filter final folder format forward frame function "
    "gateway generate global graph group handle header height history host image import index information input insert install instance internal invoice item journal kernel keyboard label language "
    "layer layout length library limit link listen local location logger machine manager market master matrix measure member memory merge message method metric migrate model module monitor network "
    "notification number object observer offset operator option order output package page parameter parent parse partition password patch pattern payment pipeline player plugin policy position "
    "prefix preview primary private process product profile program project property provider public publish query queue random range reader record reference region register release remote render "
    "replace report request resource response result return review router sample schedule schema scope screen search second section security select sequence server service session setting shadow "
    "shared shutdown signal simple single snapshot source standard start statement static status storage stream string structure style submit summary support switch system table target template "
    "terminal testing thread ticket timeout tracker transaction transfer transform translate update upload utility validate value variable vector version viewer visible volume warning widget window "
    "worker workflow writer zone"
).split()


def labelled_sample(spark: SparkSession, size: int = 3000) -> DataFrame:
    """(text, secret): random strings over mixed, base64, one-case, upper-case hex and digit alphabets, and identifiers
    joined from WORDS in the usual styles, all from a fixed rule."""

    def digits(i, salt):
        return int.from_bytes(hashlib.sha512(f"{salt}:{i}".encode()).digest(), "big")

    def draw(alphabet, n, x):
        out = []
        for _ in range(n):
            x, r = divmod(x, len(alphabet))
            out.append(alphabet[r])
        return "".join(out)

    numerals = ALPHABET[52:62]
    alphabets = (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + numerals, ALPHABET[:6] + numerals, numerals)
    rows = []
    for i in range(size):
        x = digits(i, "random")
        rows.append((draw(alphabets[i % 6], 24 + i % 17, x), True))
        y, n = digits(i, "words"), 2 + i % 4
        parts = [WORDS[(y >> (12 * k)) % len(WORDS)] for k in range(n)]
        style = i % 7
        joined = {0: "_".join(parts), 1: "-".join(parts), 2: "".join(p.title() for p in parts), 3: parts[0] + "".join(p.title() for p in parts[1:]), 4: "/".join(parts), 5: "_".join(parts).upper(), 6: "".join(parts)}[style]
        rows.append((joined + ("", "", str(y % 100), f"_{y % 10000}", f"/{2000 + y % 30}", "=")[i % 6], False))
    return spark.createDataFrame(rows, "text string, secret boolean")


def codes(text: Column) -> Column:
    """Places of the characters in ALPHABET, from 1; 0 for any other."""
    return F.transform(F.split(text, ""), lambda c: F.position(c, F.lit(ALPHABET)))


def transitions(text: Column) -> Column:
    """Cell of the table for each pair of neighbouring characters."""
    return F.when(F.length(text) < 2, F.array().cast("array<int>")).otherwise(
        let(codes(text), lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: a * WIDE + b))
    )


def fit(sample: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition: random strings over ordinary identifiers."""
    cells = sample.where("text is not null and secret is not null").select("secret", F.explode(transitions(F.col("text"))).alias("cell"))
    counts = {(r[0], r[1]): r[2] for r in cells.groupBy("secret", "cell").count().collect()}  # alphabet squared, twice
    def logs(label):
        out = []
        for a in range(WIDE):
            row = [counts.get((label, a * WIDE + b), 0) + 1 for b in range(WIDE)]
            out += [math.log(x / sum(row)) for x in row]
        return out

    return [a - b for a, b in zip(logs(True), logs(False), strict=True)]


def markov_spans(text: Column, ratios: list[float]) -> Column:
    """Parts of candidates that the models call random. Candidates are scored first; only a text with a random part has its
    candidates' places found."""
    grid = F.expr(f"cast(split('{' '.join(f'{x:.5f}' for x in ratios)}', ' ') as array<double>)")

    parts = F.array().cast("array<struct<a:int,b:int,sum:double>>")

    def walked(cells):
        """Parts of a candidate as (first transition, transition after the last, sum)."""
        zero, no = F.lit(0.0), F.lit(0)

        def state(at, total, start, peak, end, out):
            return F.struct(at.alias("at"), total.alias("sum"), start.alias("start"), peak.alias("peak"), end.alias("end"), out.alias("out"))

        def closed(x):
            good = (x["peak"] >= THRESHOLD) & (x["peak"] >= MARGIN * (x["end"] - x["start"]))
            return F.when(good, F.concat(x["out"], F.array(F.struct(x["start"].alias("a"), x["end"].alias("b"), x["peak"].alias("sum"))))).otherwise(x["out"])

        def step(x, c):
            at = x["at"] + 1

            def moved(total):
                over = (total <= 0) | (total < x["peak"] - DROP)
                return F.when(over, state(at, zero, at, zero, at, closed(x))).when(total > x["peak"], state(at, total, x["start"], total, at, x["out"])).otherwise(state(at, total, x["start"], x["peak"], x["end"], x["out"]))

            return let(x["sum"] + F.get(grid, c), moved)

        return F.aggregate(cells, state(no, zero, no, zero, no, parts), step, closed)

    def random_parts(m):
        """Parts of the candidate m, from the first character to the one after the last."""

        def kept(p):
            plain = F.substring(m, p["a"] + 1, p["b"] - p["a"] + 1).rlike(PLAIN)
            return ~plain | ((p["sum"] >= PLAIN_THRESHOLD) & (p["sum"] >= PLAIN_MARGIN * (p["b"] - p["a"])))

        def whole(p):
            """To the ends of the letters and digits around a part, which belong to the same string."""
            before, after = F.substring(m, F.lit(1), p["a"]), F.substring(m, p["b"] + 2, F.length(m))
            return F.struct((p["a"] - F.length(F.regexp_extract(before, "[A-Za-z0-9]*$", 0))).alias("a"), (p["b"] + 1 + F.length(F.regexp_extract(after, "^[A-Za-z0-9]*", 0))).alias("b"))

        def joined(out, p):
            last = F.get(out, F.size(out) - 1)
            one = F.struct(last["a"].alias("a"), F.greatest(last["b"], p["b"]).alias("b"))
            return F.when((F.size(out) > 0) & (p["a"] <= last["b"]), F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(one))).otherwise(F.concat(out, F.array(p)))

        return F.aggregate(F.transform(F.filter(walked(transitions(m)), kept), whole), F.array().cast("array<struct<a:int,b:int>>"), joined)

    def spans(s, start):
        def span(p):
            return F.struct(F.lit(3).alias("kind"), (start + p["a"]).alias("start"), (start + p["b"]).alias("end"), F.substring(s["m"], p["a"] + 1, p["b"] - p["a"]).alias("match"))

        return F.transform(s["p"], span)

    def placed(scored):
        return F.when(F.exists(scored, lambda s: F.size(s["p"]) > 0), F.flatten(F.zip_with(scored, starts(text, CANDIDATE), spans)))

    scored = F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda m: F.struct(m.alias("m"), random_parts(m).alias("p")))
    return F.coalesce(let(scored, placed), F.array().cast(SPANS))


def apart(text: Column, tried: Column, base: Column) -> Column:
    """The spans tried that overlap no span of base: base spans are blotted out in the text's characters, and a span that has a blot
    overlaps one. Linear in the text and the spans."""

    def blot(x, y):
        """x and y are the same text, each with some characters blotted out."""
        return F.zip_with(x, y, lambda a, b: F.when((a == MARK) | (b == MARK), F.lit(MARK)).otherwise(a))

    def one(kind):
        own = F.filter(base, lambda s: s["kind"] == kind)

        def covered(mine):
            # The text between the spans of one kind, which don't overlap, and marks in their place.
            ends = F.concat(F.array(F.lit(0)), F.transform(mine, lambda s: s["end"]))
            begins = F.concat(F.transform(mine, lambda s: s["start"]), F.array(F.length(text)))
            gap = F.zip_with(ends, begins, lambda e, b: b - e)
            length = F.concat(F.transform(mine, lambda s: s["end"] - s["start"]), F.array(F.lit(0)))
            return chars(F.array_join(F.zip_with(gap, length, lambda g, n: F.concat(F.repeat(F.lit("."), g), F.repeat(F.lit(MARK), n))), ""))

        return let(own, covered)

    def free(blots):
        return F.filter(tried, lambda s: ~F.array_contains(F.slice(blots, s["start"] + 1, s["end"] - s["start"]), MARK))

    return F.when((F.size(tried) == 0) | (F.size(base) == 0), tried).otherwise(let(blot(blot(one(0), one(1)), one(2)), free))


def listed(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float], kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns, base and added (spans with their matches) of every row."""
    rows = docs.select(*[F.col(k) for k in kept], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    rows = rows.select(*kept, "_t", base_spans(F.col("_t")).alias("base"), markov_spans(F.col("_t"), ratios).alias("tried"))
    return rows.select(*kept, "base", apart(F.col("_t"), F.col("tried"), F.col("base")).alias("added"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found_ = scan(table(spark, sf_dir, "documents"), fit(labelled_sample(spark)), ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found_.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "added")).alias("spans"),
    )
