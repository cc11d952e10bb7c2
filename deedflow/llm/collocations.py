"""Phrase collocations: frequent phrases of 2 to 4 words, scored by their weakest cut, in each language.

1. Texts are split into pieces at punctuation and line ends; identical pieces of a language become one row with its
   multiplicity (an aggregation with a map side, so that a line that everything repeats is one row a task).
2. N-grams are counted length by length. A run of n words can only reach the floor if both of its runs of n - 1 words
   do, so a task keeps the runs whose two parts are in a Bloom filter of the frequent ones: a fixed number of bits (so the
   broadcast is bounded), sized by the count and never losing a member; a false hit costs a row that the count then drops.
   Runs are added up in each batch before they are shuffled by hash, and each hash bucket is summed by duckdb out of core
   (`MEMORY`, spilling to the task's own scratch folder, which goes with the task and which nothing else reads).
3. Every cut of a candidate asks for the counts of its two parts: requests and counts are shuffled by part and joined there,
   with AQE splitting parts that very many candidates share.
4. Longer candidates tell the phrases inside them their count; the largest (a map-side maximum) decides what they cover.
5. Ranks are by `common.ranked`: no task gets a whole language.

Arithmetic is exact: sums are longs (128 bits inside duckdb), products decimals of 38 digits.

Defined results: null texts are empty and have no pieces; null languages are `und`; empty tables give no rows; repeated rows
count as often as they stand; of equal scores the higher count, then the smaller phrase (UTF-8 bytes) goes first;
other columns aren't read. Texts and pieces may have any length.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import reduce

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, cut, drop_cut, lean, ranked, shuffle_width, small_batches, table
from .decontaminate import LOWER, UPPER

FLOOR, LONGEST, TOP, COVER = 30, 4, 2000, 80
PIECE_END = r"[.,;:!?\x0A-\x0D]"
#: Of one bucket's sums in duckdb; beyond it duckdb spills.
MEMORY = "256MB"
#: Bits of a filter: 16 a frequent run, at least and at most so many (32 MB). A fuller filter only prunes less.
LEAST_BITS, MOST_BITS, PROBES = 1 << 16, 1 << 28, 3
#: Words of a batch that is added up before the shuffle.
BATCH_WORDS = 1_000_000
#: Languages up to so many are broadcast with their totals.
BROADCAST_GROUPS = 100_000
GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("f", pa.int64())])
DDL = "lang string, gram string, f long"
MIX = np.uint64(0x9E3779B97F4A7C15)


def pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, piece (words joined by one space), m: how often the piece stands in that language's texts."""
    raw = F.col(text)
    low = F.when(F.length(raw) == F.octet_length(raw), F.lower(raw)).otherwise(F.translate(raw, UPPER, LOWER))
    each = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(low, PIECE_END)).alias("piece"))
    plain = F.trim(F.regexp_replace(F.translate("piece", "\t", " "), "  +", " "))
    return each.select("lang", plain.alias("piece")).where("piece <> ''").groupBy("lang", "piece").agg(F.count("*").alias("m"))


def string_hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def chained(langs: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of runs, by the hashes of their language and their words."""
    out = langs
    for w in words:
        out = (out ^ w) * MIX
        out = out ^ (out >> np.uint64(29))
    return out


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (hashes * MIX) | np.uint64(1)
    return [(hashes + np.uint64(k) * step) >> np.uint64(64 - bits.bit_length() + 1) for k in range(PROBES)]


def member(hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
    bits = len(cells) * 64
    hit = np.ones(len(hashes), bool)
    for at in probes(hashes, bits):
        hit &= (cells[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return hit


def bloom(grams: DataFrame) -> Broadcast:
    """A filter of all runs of grams, broadcast: an array of 64-bit cells, at most MOST_BITS / 64 of them."""
    bits = min(max(LEAST_BITS, 1 << (16 * grams.count()).bit_length()), MOST_BITS)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = pc.split_pattern(b["gram"], " ")
            lengths = pc.list_value_length(words).to_numpy()
            if not len(lengths):
                continue
            w = string_hashes(pc.list_flatten(words)).reshape(len(lengths), lengths[0])
            at = np.concatenate(probes(chained(string_hashes(b["lang"]), list(w.T)), bits))
            yield pa.RecordBatch.from_pydict({"cell": (at >> np.uint64(6)).astype("int64"), "mask": (np.uint64(1) << (at & np.uint64(63))).view("int64")})

    set_ = grams.mapInArrow(cells, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[set_["cell"].to_numpy()] = set_["mask"].to_numpy().view(np.uint64)
    return grams.sparkSession.sparkContext.broadcast(out)


def runs_of(batch: pa.Table, size: int, known: np.ndarray | None) -> pa.RecordBatch:
    """All runs of size words in the pieces of a batch whose two shorter runs are known, each once with its weight."""
    split = pc.split_pattern(batch["piece"].combine_chunks(), " ")
    lengths = pc.list_value_length(split).to_numpy()
    coded = pc.list_flatten(split).dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    langs = batch["lang"].combine_chunks().dictionary_encode()
    lang = np.repeat(langs.indices.to_numpy(), lengths)
    weight = np.repeat(batch["m"].to_numpy(), lengths)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # words from here to the piece's end
    at = np.flatnonzero(room >= size)
    if size > 1 and len(at):
        n = len(codes) - size + 2
        hashes = string_hashes(words)[codes]
        inside = member(chained(string_hashes(langs.dictionary)[lang[:n]], [hashes[i : n + i] for i in range(size - 1)]), known)
        at = at[inside[at] & inside[at + 1]]
    keys = [f"w{i}" for i in range(size)]
    found = pa.table({"lang": lang[at], **{k: codes[at + i] for i, k in enumerate(keys)}, "m": weight[at]}).group_by(["lang", *keys]).aggregate([("m", "sum")])
    parts = [words.take(found[k].combine_chunks()) for k in keys]
    gram = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
    return pa.RecordBatch.from_arrays([langs.dictionary.take(found["lang"].combine_chunks()), gram, found["m_sum"].combine_chunks()], schema=GRAMS)


def emitter(size: int, known: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held, chars = known.value if known else None, [], 0
        for b in batches:
            held.append(b)
            chars += b["piece"].nbytes
            if chars >= 6 * BATCH_WORDS:
                yield from _sliced(runs_of(pa.Table.from_batches(held), size, cells))
                held, chars = [], 0
        if held:
            yield from _sliced(runs_of(pa.Table.from_batches(held), size, cells))

    return lean(run)


def _sliced(b: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, b.num_rows, rows):
        yield b.slice(i, rows)


def bucket_sums(floor: int, memory: str):
    """A bucket's runs of floor occurrences or more, summed by duckdb."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as scratch:
            db = duckdb.connect(config={"memory_limit": memory, "threads": 1, "temp_directory": scratch, "preserve_insertion_order": False})
            parts = pa.RecordBatchReader.from_batches(GRAMS, (b.cast(GRAMS) for b in batches))  # noqa: F841  duckdb reads it by name
            out = db.sql(f"SELECT lang, gram, CAST(sum(f) AS BIGINT) AS f FROM parts GROUP BY lang, gram HAVING sum(f) >= {floor}").to_arrow_reader(50_000)
            for b in out:
                yield b.cast(GRAMS)
            db.close()

    return lean(run)


def frequent(cleaned: DataFrame, size: int, known: Broadcast | None, floor: int, memory: str = MEMORY) -> DataFrame:
    """lang, gram, f of all runs of size words with f >= floor."""
    parts = cleaned.mapInArrow(emitter(size, known), DDL).repartition(shuffle_width(cleaned.sparkSession), "lang", "gram")
    return parts.mapInArrow(bucket_sums(floor, memory), DDL)


def counts(cleaned: DataFrame, longest: int, floor: int, made: list[DataFrame]) -> DataFrame:
    """lang, gram, f, size of all runs of 1 to longest words with f >= floor; each length's table is written."""
    out, known = [], None
    for size in range(1, longest + 1):
        got = cut(frequent(cleaned, size, known, floor), made)
        if known:
            known.destroy()
        out.append(got.withColumn("size", F.lit(size)))
        known = bloom(got) if size < longest else None
    return reduce(DataFrame.unionByName, out)


def _part(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(grams: DataFrame) -> DataFrame:
    """lang, gram, a, size, k, l, r, score of each run of two words or more, by its lowest-scoring cut."""
    words = F.split("gram", " ")
    cuts = grams.where("size > 1").select("lang", "gram", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    asked = cuts.select("*", F.explode(F.array(F.struct(F.lit("l").alias("side"), _part(words, 1, F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))).alias("ask")).select("lang", "gram", "a", "size", "k", "ask.*")
    told = asked.join(grams.select("lang", F.col("gram").alias("part"), "f"), ["lang", "part"])
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f")))
    both = told.groupBy("lang", "gram", "a", "size", "k").agg(side("l").alias("l"), side("r").alias("r"))
    both = both.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(18, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"))
    best = both.groupBy("lang", "gram", "a", "size").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "gram", "a", "size", "b.*")


def covered(grams: DataFrame) -> DataFrame:
    """lang, gram, most: the largest count of a longer run that has the words of gram in it."""
    words, size = F.split("gram", " "), F.col("size")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    return grams.where("size > 2").select("lang", F.explode(spans).alias("gram"), "f").groupBy("lang", "gram").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", floor: int = FLOOR, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases."""
    made: list[DataFrame] = []
    spark = docs.sparkSession
    try:
        with small_batches(spark):
            cleaned = cut(pieces(docs, text, lang), made)
        grams = counts(cleaned, longest, floor, made)
        every = scored(grams).join(covered(grams), ["lang", "gram"], "left")
        wide = lambda c: F.col(c).cast("decimal(20,0)")
        free = every.where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * cover))
        placed = ranked(free.select("lang", F.col("gram").alias("phrase"), "a", "l", "r", "score"), [F.desc("score"), F.desc("a"), F.asc("phrase")], ("lang",)).where(F.col("rank") <= top)
        totals = cut(cleaned.groupBy("lang").agg(F.sum(F.col("m") * F.size(F.split("piece", " "))).alias("n")))
    finally:
        drop_cut(*made)
    return placed.join(bounded(totals, BROADCAST_GROUPS), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), q AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m AS size, array_to_string(w[i:i + m - 1], ' ') AS gram, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM q, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m) GROUP BY ALL
), c AS (SELECT lang, size, gram, string_split(gram, ' ') AS w, f AS a FROM g WHERE size > 1 AND f >= 30),
cuts AS (SELECT lang, gram, size, w, a, unnest(range(1, size)) AS k FROM c),
asked AS (SELECT lang, gram, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:size], ' ') AS rp FROM cuts),
s AS (
  SELECT x.lang, x.gram, x.a, x.k, gl.f AS l, gr.f AS r, CAST(CAST(2000000 AS HUGEINT) * x.a // (CAST(gl.f AS HUGEINT) + gr.f) AS BIGINT) AS score
  FROM asked x JOIN g gl ON gl.lang = x.lang AND gl.gram = x.lp JOIN g gr ON gr.lang = x.lang AND gr.gram = x.rp
), best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS gram, max(a) AS most
  FROM (SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < size) GROUP BY ALL
), free AS (SELECT b.* FROM best b LEFT JOIN inner_ i USING (lang, gram) WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank FROM free)
SELECT lang, rank, gram AS phrase, a, l, r, n, score FROM r JOIN (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM q GROUP BY lang) USING (lang) WHERE rank <= 2000
"""
