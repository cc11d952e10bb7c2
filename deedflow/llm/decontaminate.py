r"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are runs of 0-9, a-z (A-Z lowered) and non-ASCII characters. Of each text's GRAM-word hashes, the smallest (rightmost on a
tie) of every window of SPAN - GRAM + 1 is kept as a fingerprint, so that two texts sharing SPAN consecutive words
share a fingerprint at the same place of that span. Document fingerprints meet benchmark fingerprints by hash;
each meeting is then extended word by word, to both sides and on the words themselves, by SPAN - GRAM words at
most: a run of SPAN words or more is a hit, and every occurrence of a SPAN-word window lies in such a run. Items of
fewer words are one window each; they are met by the hash of all their words (a window of one hash), for the lengths that occur.

Only fingerprints that the benchmark has leave their task, grouped by document; the texts of documents with
meetings are read again for the extension. Documents go by (doc_id, hash of text), so repeated rows and ids that
repeat with other texts each get their own row and result.

Texts of any length are read whole: a long one is one row of its task, and only its fingerprints that the benchmark has leave it.

Defined results: null and empty texts have no words and no hits; an empty benchmark hits nothing; a null item_id's windows
hit, but it isn't listed or counted among the items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, cut, table

SPAN, GRAM = 10, 5
#: What stands between words. Splitting at these takes a seventh of the time of extracting the words by the negated class.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A fingerprint is a hash in the upper bits and, so that the rightmost wins a tie, the complement of its place below.
PLACE = (1 << 28) - 1
#: Benchmark fingerprints up to so many rows (about 300 bytes each with their context) are broadcast; more are shuffled.
BROADCAST_ROWS = 200_000
#: Keys of documents (16 bytes each) up to so many rows are broadcast to pick out their texts; for more, texts are shuffled.
BROADCAST_KEYS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, use) -> Column:
    """use(value), with value evaluated once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Words of a text; none of a null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def grams(words: Column, size: int) -> Column:
    """Packed hash and place of every run of size words."""

    def packed(i):
        h = F.xxhash64(F.lit(size), *[F.get(words, i + j) for j in range(size)])
        return h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(F.lit(PLACE).cast("long") - i.cast("long"))

    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), packed)).otherwise(F.array().cast("array<bigint>"))


def winnowed(words: Column, span: int, gram: int) -> Column:
    """The packed minima of all windows of span - gram + 1 grams."""
    wide = span - gram + 1

    def minima(g):
        at = F.sequence(F.lit(0), F.size(g) - wide)
        return F.array_distinct(F.transform(at, lambda j: F.least(*[F.get(g, j + i) for i in range(wide)]) if wide > 1 else F.get(g, j)))

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= span, let(grams(words, gram), minima)).otherwise(none)


def fingerprints(words: Column, lengths: list[int], span: int, gram: int) -> Column:
    """array<struct<size, v>>: winnowed grams (size = gram), and all runs of each shorter length (size = -length)."""
    return F.concat(_tagged(winnowed(words, span, gram), gram), *[_tagged(grams(words, m), -m) for m in lengths])


def _tagged(values: Column, size: int) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(size).alias("size"), v.alias("v")))


def _hash(v: Column) -> Column:
    return F.shiftright(v, 28)


def _place(v: Column) -> Column:
    return (F.lit(PLACE) - v.bitwiseAND(F.lit(PLACE))).cast("int")


def _context(words: Column, at: Column, size: Column, reach: int) -> list[Column]:
    """The words of a run, and up to reach words before (nearest first) and after it."""
    before = F.least(at, F.lit(reach))
    return [
        F.slice(words, at + 1, size).alias("mid"),
        F.reverse(F.slice(words, at - before + 1, before)).alias("left"),
        F.slice(words, at + size + 1, F.lit(reach)).alias("right"),
    ]


def _common(a: str, b: str, reach: int) -> Column:
    """Number of equal elements at the front of two arrays."""
    same = [F.get(F.col(a), F.lit(i)) == F.get(F.col(b), F.lit(i)) for i in range(reach)]
    return reduce(lambda rest, x: F.when(x, rest + 1).otherwise(F.lit(0)), reversed(same), F.lit(0))


def benchmark_index(benchmark: DataFrame, item: str, text: str, span: int, gram: int) -> tuple[DataFrame, list[int]]:
    """(size, hash, item, mid, left, right) of every benchmark fingerprint; lengths of items under span words."""
    base = cut(benchmark.select(F.col(item).alias("_item"), words_of(F.col(text)).alias("_words")).where(F.size("_words") > 0))
    lengths = sorted(r[0] for r in base.where(F.size("_words") < span).select(F.size("_words")).distinct().collect())
    whole = base.where(F.size("_words") >= span).withColumn("_f", F.explode(fingerprints(F.col("_words"), [], span, gram)))
    short = [base.where(F.size("_words") == m).withColumn("_f", F.explode(_tagged(grams(F.col("_words"), m), -m))) for m in lengths]
    every = reduce(DataFrame.unionByName, short, whole)
    place, size = _place(F.col("_f.v")), F.abs(F.col("_f.size"))
    index = every.select(F.col("_f.size").alias("_size"), _hash(F.col("_f.v")).alias("_hash"), "_item", *_context(F.col("_words"), place, size, span - gram))
    return cut(index.distinct()), lengths


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """key, _text (hash of the text), n_words, n_hit, n_items, items (sorted strings), rows: one row per distinct (key, text)."""
    index, lengths = benchmark_index(benchmark.select(item, text), item, text, span, gram)
    rows = index.limit(BROADCAST_ROWS + 1).count()
    near = F.broadcast if rows <= BROADCAST_ROWS else (lambda x: x)
    known = near(index.select("_size", "_hash").distinct().withColumn("_known", F.lit(True)))
    base = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text).cast("string")).alias("_text"), F.col(text).alias("_raw"))
    # One pass over all texts. A first element that no benchmark row meets carries the word count and counts the row; where the index is
    # shuffled, its key is the text's hash, so that these elements don't meet in one task.
    # let() keeps the words of a text in one evaluation, whatever the optimizer does with projections.
    prints = let(words_of(F.col("_raw")), lambda w: _with_words(w, lengths, span, gram, bool(rows)))
    tried = base.select("_key", "_text", F.explode(prints).alias("_f")).select("_key", "_text", F.col("_f.size").alias("_size"), F.col("_f.v").alias("_v"), F.when(F.col("_f.size") != 0, _hash(F.col("_f.v"))).otherwise(F.col("_text")).alias("_hash"))
    met = tried.join(known, ["_size", "_hash"], "left").where("_known or _size = 0")
    heads = met.groupBy("_key", "_text").agg(
        F.max(F.when(F.col("_size") == 0, F.col("_v"))).alias("n_words"),
        F.count_if(F.col("_size") == 0).alias("rows"),
        F.collect_set(F.when(F.col("_size") != 0, F.struct("_size", "_v"))).alias("met"),
    )
    heads = cut(heads)
    hit = heads.where(F.size("met") > 0).select(F.col("_key").alias("_k"), F.col("_text").alias("_t"), "met")
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t"))
    again = base.join(bounded(hit.select("_k", "_t"), BROADCAST_KEYS), same, "left_semi").join(hit, same)
    reach = span - gram
    sides = let(
        words_of(F.col("_raw")),
        lambda w: F.transform(F.col("met"), lambda f: F.struct(f["_size"].alias("_size"), _hash(f["_v"]).alias("_hash"), _place(f["_v"]).alias("at"), *[c.alias(f"d{c_name}") for c, c_name in zip(_context(w, _place(f["_v"]), F.abs(f["_size"]), reach), ("mid", "left", "right"), strict=True)])),
    )
    spots = again.select("_key", "_text", F.explode(sides).alias("s")).select("_key", "_text", "s.*").distinct()
    pairs = spots.join(near(index), ["_size", "_hash"]).where(F.col("mid") == F.col("dmid"))
    back = F.when(F.col("_size") > 0, _common("left", "dleft", reach)).otherwise(0)
    ahead = F.when(F.col("_size") > 0, _common("right", "dright", reach)).otherwise(0)
    runs = pairs.select("_key", "_text", "_item", (F.col("at") - back).alias("a"), (F.col("at") + F.abs("_size") + ahead).alias("b"), "_size")
    runs = runs.where((F.col("_size") < 0) | (F.col("b") - F.col("a") >= span))
    # An item's runs of one document become one row in the map-side half of this aggregation.
    hits = runs.groupBy("_key", "_text").agg(
        F.collect_set(F.struct("a", "b")).alias("runs"),
        F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["a"], r["b"] - 1)))))
    hits = hits.select(F.col("_key").alias("_k"), F.col("_text").alias("_t"), covered.cast("long").alias("n_hit"), "items")
    out = heads.drop("met").join(hits, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")), "left").drop("_k", "_t")
    return out.select(F.col("_key").alias(key), "_text", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "rows")


def _with_words(w: Column, lengths: list[int], span: int, gram: int, any_item: bool) -> Column:
    head = F.array(F.struct(F.lit(0).alias("size"), F.size(w).cast("long").alias("v")))
    return F.concat(head, fingerprints(w, lengths, span, gram)) if any_item else head


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """docs without the rows that share a window with the benchmark."""
    bad = cut(contamination(docs, benchmark, key, text, item).where("n_hit > 0").select(F.col(key).alias("_k"), F.col("_text").alias("_t")))
    return docs.join(bounded(bad, BROADCAST_KEYS), F.col(key).eqNullSafe(F.col("_k")) & (F.xxhash64(F.col(text).cast("string")) == F.col("_t")), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM bw), dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes)
), hit AS (SELECT doc_id, item_id, m, i FROM dw JOIN bw USING (m, win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
