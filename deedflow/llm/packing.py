"""Best-fit packing with conflicts.

Texts go into bins of CAPACITY words. A text longer than that fills bins of its own with full pieces and leaves a
remainder, which is packed like a short text. No bin holds two pieces of one source or of one duplicate
cluster (by default texts with the same words; with near, groups of texts linked at a Jaccard similarity of shingles, as the
join finds them over the whole table). In each task, open bins are kept in the order of their residual, with a
bitmap of the sources and one of the duplicate clusters they hold. Pieces go by descending size: the search begins
at the smallest residual that is enough and goes on through the successors until the tightest compatible bin is
found; without one a bin is opened. There is no limit on the search or on bins.

Documents are dealt to tasks by a hash, about PER_TASK each, and each task packs its own: memory and search are
bounded whatever the corpus or its hottest source or cluster, and a lost task packs the same again. Equal rows go to
several tasks where they are more than an eighth of one.

Defined results: a text without words (null, empty, spaces) gets one row with no bin; a null source is a source
like another; repeated rows are packed each.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec
from .common import bounded, cut, drop_cut, lean, small_batches, table
from .jaccard_join import classes

CAPACITY, PER_TASK = 2048, 8192
#: A table of (hash, parts) of so many rows at most is broadcast.
HOT_ROWS = 500_000


def sequence_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of words, hash of the word sequence) of each text."""
    h, doc, _, _ = textvec.words(data, offsets)
    n = len(offsets) - 1
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    place = (np.arange(len(h)) - first[doc]).astype(np.uint64)
    part = textvec.mix(h + (place + np.uint64(1)) * np.uint64(textvec.BASE))
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(count)
    if len(some):
        out[some] = np.add.reduceat(part, first[some])
    return count, textvec.mix(out)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and, in place of the text, the hash of the word sequence."""
    for batch in batches:
        parts = [sequence_hashes(d, o) for _, d, o in textvec.groups(batch.column(batch.num_columns - 1))]
        count = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        ids = np.concatenate([p[1].view(np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(count), pa.array(ids)], names=[*batch.schema.names[:-1], "n_words", "words_hash"])


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, placed by descending size (ties in the order given)."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    seen: set = set()
    again = dict.fromkeys(c for c in clusters if c in seen or seen.add(c))  # a cluster of one can't conflict
    cluster_bit = {c: 1 << i for i, c in enumerate(again)}
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[list[int]] = []  # sources, clusters
    out: list[tuple[int, int]] = [(-1, -1)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, s, c = sizes[i], source_bit[sources[i]], cluster_bit.get(clusters[i], 0)
        at = bisect_left(order, (size, -1))
        while at < len(order):
            have = held[order[at][1]]
            if not (have[0] & s or have[1] & c):
                break
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(held)
            held.append([0, 0])
        out[i] = (b, capacity - left)
        held[b][0] |= s
        held[b][1] |= c
        if left > size:
            insort(order, (left - size, b))
    return out


PACKED = "piece long, start long, length long, bin_id long, offset long"


def _pack(capacity: int):
    schema = pa.schema([("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("bin_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        part = TaskContext.get().partitionId()
        batches = list(batches)  # ids, sources and sizes of about PER_TASK documents; no text
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        ids, sources = rows.column(0), rows.column(1).to_pylist()
        clusters, words = rows.column(2).to_pylist(), rows.column(3).to_pylist()
        rest = [i for i, n in enumerate(words) if n % capacity]
        # Rows arrive in any order after a shuffle: a fixed one makes a repeated task give the same bins.
        keys = ids.to_pylist()
        rest.sort(key=lambda i: (words[i] % capacity, keys[i] is None, keys[i], clusters[i] is None, clusters[i], sources[i] is None, sources[i]))
        placed = dict(zip(rest, best_fit([words[i] % capacity for i in rest], [sources[i] for i in rest], [clusters[i] for i in rest], capacity), strict=True))
        bins = 1 + max((b for b, _ in placed.values()), default=-1)
        out, take = [], []
        for i in sorted(range(len(words)), key=lambda i: (keys[i] is None, keys[i], str(clusters[i]), str(sources[i]))):
            for p in range(words[i] // capacity):
                out.append((p, p * capacity, capacity, part << 40 | bins, 0))
                bins += 1
                take.append(i)
            if i in placed:
                b, offset = placed[i]
                p = words[i] // capacity
                out.append((p, p * capacity, words[i] % capacity, part << 40 | b, offset))
                take.append(i)
            elif not words[i]:
                out.append((0, 0, 0, None, None))
                take.append(i)
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
        result = pa.table([ids.take(pa.array(take)), *columns], names=["_key", *schema.names])
        yield from result.to_batches(10_000)

    return run


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None, capacity: int = CAPACITY, per_task: int = PER_TASK, near: tuple[int, int] | None = None) -> DataFrame:
    """key, piece, start, length (words), bin_id, offset (in the bin): one row per piece. cluster names a column of
    duplicate classes; without one, near-copies linked at near = (words of a shingle, percent) are a class, or, without that,
    texts with the same words."""
    own, done = F.col(source).cast("string").alias("_source"), []
    if near and not cluster:
        found, done = classes(docs, *near, [own], key, text)
        sized = found.withColumnsRenamed({"id": "_key", "words": "n_words", "class": "words_hash"})
    else:
        rows = docs.select(F.col(key).alias("_key"), own, *([F.col(cluster).cast("string").alias("_cluster")] if cluster else []), F.col(text).cast("string").alias("_t"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_t").schema)
        sized = rows.mapInArrow(lean(_sizes), f"{schema}, n_words long, words_hash long")
    # Texts without words have no duplicates.
    dup = F.col("_cluster") if cluster else F.when(F.col("n_words") > 0, F.col("words_hash").cast("string"))
    sized = sized.select("_key", "_source", dup.alias("_cluster"), "n_words").withColumns({"_hash": F.xxhash64("_key", "_source", "_cluster", "n_words"), "_row": F.monotonically_increasing_id()})
    with small_batches(docs.sparkSession):
        sized = cut(sized)
    drop_cut(*done)
    tasks = max(1, math.ceil(sized.count() / per_task))
    # Rows are dealt by what they hold; equal rows beyond a share of a task also by their numbers in the written table.
    share = max(1, per_task // 8)
    hot = cut(sized.groupBy("_hash").agg(F.ceil(F.count("*") / share).alias("_parts")).where("_parts > 1"))
    salt = F.when(F.col("_parts").isNotNull(), F.pmod("_row", "_parts")).otherwise(0)
    dealt = sized.join(bounded(hot, HOT_ROWS), "_hash", "left").repartition(tasks, "_hash", salt).select("_key", "_source", "_cluster", "n_words")
    out = dealt.mapInArrow(lean(_pack(capacity)), f"_key {docs.schema[key].dataType.simpleString()}, {PACKED}")
    return out.withColumnRenamed("_key", key)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), near=(5, 80))
