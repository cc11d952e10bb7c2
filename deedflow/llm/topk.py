"""Exact top-k search by inner product: an impact-ordered index, processed score at a time.

Vectors become integers, floor(SCALE * x). Candidates are dealt into blocks, by LEVELS of their norms and in a level by a hash of
their id, and a task builds its block's index once: for every dimension and quantised impact (component value), the segment of candidates with it. Queries
then stream over the index in slabs. Segments go by descending magnitude of impact; each adds impact times query component
to its candidates' accumulators, for the whole slab at once. What a candidate still misses is at most the query's norm
times the norm of its components not yet processed (Cauchy-Schwarz), which bounds every score from both sides. Processing
stops only when these bounds leave few possible members of a top k; those are rescored exactly. Without such proof it
goes on until the accumulators are exact.

The first block, of the greatest norms, is searched before the others. A query's k-th score there is a floor for all others: a query isn't
sent to blocks whose norms can't reach it, the bounds are held against it, and only scores that reach it leave a task. The
best of all blocks then meet by query. Vectors of about equal norms are all sent, as nothing is known of them before they meet. Queries are split among tasks only beyond QUERIES of them, so that candidates are
sent once for so many queries, and queries once for every block of candidates.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows with a null
id. Equal (id, vector) rows count once. A candidate never answers a query of its own id. Vectors of different length
don't meet. Ties go to the smaller id; a query with fewer than k candidates gets all of them. Scores that don't fit a long are an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, drop_cut, shuffle_width, table

SCALE, K = 64, 20
#: Ranges of norms that blocks are formed in, at most; each has as many rows as a block, at least.
LEVELS = 32
CANDIDATES, QUERIES = 4096, 65536
#: Queries of one task against the first block, and of one slab.
FIRST, SLAB = 1024, 512
#: The proof is tried when so many of the postings are done; the first one where all floors are known.
TRY_AT = (0.6, 0.8, 0.9)
#: It ends the work when this share of the block, at most, is left possible.
FEW = 0.08
NO_FLOOR = -(2**63)


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


class Index:
    """Segments of one block of integer vectors, by descending magnitude of impact."""

    def __init__(self, vectors: np.ndarray):
        n, self.dims = vectors.shape
        row, dim = np.nonzero(vectors)
        value = vectors[row, dim]
        order = np.lexsort((row, value, dim, -np.abs(value)))
        row, dim, value = row[order], dim[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])])) if len(row) else np.zeros(0, int)
        ends = np.append(new, len(row))  # a block of zero vectors has no segment
        self.segments = [(int(dim[a]), int(value[a]), row[a:b]) for a, b in zip(new, ends[1:], strict=True)]
        self.vectors, self.size, self._rest = vectors, len(row), {}

    def rest(self, magnitude: float) -> np.ndarray:
        """An upper bound of the norm of each vector's components below magnitude."""
        if magnitude not in self._rest:
            v = np.where(np.abs(self.vectors) < magnitude, self.vectors, 0).astype(np.float64)
            self._rest[magnitude] = np.sqrt((v * v).sum(axis=1)) * (1 + 1e-9)
        return self._rest[magnitude]


def search(ids: np.ndarray, index: Index, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, candidate ids, scores) of the k best of one block, for every query; with floors (a score
    that k candidates elsewhere reach, or NO_FLOOR), only those that reach the query's."""
    vectors, norms = index.vectors, np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
    floors = np.full(len(queries), NO_FLOOR) if floors is None else floors
    # A block whose longest vector can't reach a query's floor holds none of its best.
    places = np.flatnonzero(index.rest(np.inf).max(initial=0.0) * norms * (1 + 1e-9) + 1e-3 >= floors)
    query_ids, queries, norms, floors = query_ids[places], queries[places], norms[places], floors[places]
    n, m = len(vectors), len(queries)
    bound = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(vectors.shape[1], 1)
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    by_id = np.argsort(ids, kind="stable")
    lo, hi = np.searchsorted(ids[by_id], query_ids), np.searchsorted(ids[by_id], query_ids, "right")
    own = [(r, q) for q in range(m) for r in by_id[lo[q] : hi[q]]]
    own_at = tuple(np.array(own, int).T) if own else None
    columns = np.ascontiguousarray(queries.T)
    acc = np.zeros((n, m), kind)
    known = bool((floors > NO_FLOOR).all())
    done, tries, possible = 0, [t * index.size for t in (TRY_AT if known else TRY_AT[1:])], None
    last = None
    for dim, value, rows in index.segments:
        if tries and done >= tries[0] and abs(value) != last and n > 4 * k and kind is not object:
            # All components of a greater magnitude are in: bound the others.
            tries.pop(0)
            slack = index.rest(abs(value) + 1)[:, None] * norms + 1e-12 * bound + 1e-3
            if known:
                floor = floors
            else:
                low = acc - slack
                if own_at:
                    low[own_at] = -np.inf
                floor = np.maximum(np.partition(low, n - k, axis=0)[n - k], floors)
            maybe = acc + slack >= floor
            if maybe.mean() <= FEW:
                possible = maybe
                break
        last = abs(value)
        acc[rows] += int(value) * columns[dim]
        done += len(rows)
    out = []
    own_by = {}
    for r, q in own:
        own_by.setdefault(q, []).append(r)
    for q in range(m):
        if possible is None:
            score = acc[:, q]
            take = np.arange(n)
            if n > 4 * k and kind is not object:
                more = k + len(own_by.get(q, ()))
                take = np.flatnonzero(score >= np.partition(score, n - more)[n - more]) if more < n else take
            score = score[take]
        else:
            take = np.flatnonzero(possible[:, q])
            score = vectors[take] @ queries[q]
        reach = score >= floors[q]
        take, score = take[reach], score[reach]
        if q in own_by:
            keep = ~np.isin(take, own_by[q])
            take, score = take[keep], score[keep]
        order = (np.lexsort((ids[take], -score)) if kind is not object else np.array(sorted(range(len(take)), key=lambda i: (-score[i], ids[take][i])), int))[:k]
        out.append((int(places[q]), ids[take][order], score[order]))
    return out


OUT = pa.schema([("query_id", pa.int64()), ("_qv", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("v").flatten(), np.int64).reshape(batch.num_rows, batch.column("dims")[0].as_py())


def _runs(batches):
    """Parts of batches with one value of (dims, qb, cb, asks) each."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("dims", "qb", "cb", "asks")])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                yield tuple(keys[:3, a]), bool(keys[3, a]), batch.slice(a, b - a)


def _blocks(k: int):
    """Batches sorted by block pair, its candidates first: their index is built once, and its queries stream over it."""

    def run(batches):
        at, ids, vectors, index = None, [], [], None
        for key, asks, part in _runs(batches):
            if key != at:
                at, ids, vectors, index = key, [], [], None
            if not asks:
                ids.append(np.asarray(part.column("id")))
                vectors.append(_vectors(part))
                continue
            if not len(ids):
                continue
            if index is None:
                ids, index = np.concatenate(ids), Index(np.concatenate(vectors))
                vectors = []
            query_ids, mark, queries = np.asarray(part.column("id")), np.asarray(part.column("mark")), _vectors(part)
            floors = np.asarray(part.column("floor").fill_null(NO_FLOOR))
            for a in range(0, len(query_ids), SLAB):
                b = a + SLAB
                found = search(ids, index, query_ids[a:b], queries[a:b], k, floors[a:b])
                if found:
                    where = np.repeat([a + q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(int)
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[where]), pa.array(mark[where]), pa.array(np.concatenate([i for _, i, _ in found])), pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64))], schema=OUT)

    return run


BEST = "query_id long, _qv long, vec_id long, score long"


@dataclass(frozen=True)
class Level:
    """Blocks first to last (exclusive), whose vectors have this norm at most."""

    first: int
    last: int
    norm: float


def in_blocks(rows: DataFrame) -> tuple[DataFrame, list[Level]]:
    """rows with cb, their block, and the levels of norms, greatest first. A level is a range between quantiles of the norms (equal norms are never
    parted), dealt by a hash into blocks of about CANDIDATES rows."""
    parts = min(LEVELS, max(1, rows.count() // CANDIDATES))
    cuts = sorted(set(rows.approxQuantile("norm", [i / parts for i in range(1, parts)], 1 / (8 * LEVELS)))) if parts > 1 else []
    # The level of a norm: how many cuts are at or above it, so that level 0 has the greatest.
    level = sum((F.when(F.col("norm") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows, levels, at = rows.withColumn("_level", level), {}, 0
    for r in sorted(rows.groupBy("_level").agg(F.count("*").alias("n"), F.max("norm").alias("norm")).collect()):
        blocks = math.ceil(r.n / CANDIDATES)
        levels[r._level] = Level(at, at + blocks, r.norm)
        at += blocks
    if not levels:
        return rows.withColumn("cb", F.lit(0)).drop("_level"), []
    first, wide = (F.create_map(*[F.lit(x) for k, v in levels.items() for x in (k, f(v))]) for f in (lambda v: v.first, lambda v: v.last - v.first))
    block = first[F.col("_level")] + F.pmod(F.xxhash64("id", F.lit(2)), wide[F.col("_level")]).cast("int")
    return rows.withColumn("cb", block).drop("_level"), list(levels.values())


def to_blocks(asked: DataFrame, levels: list[Level], start: int, stop: int) -> DataFrame:
    """asked, once for each block from start to stop that may hold one of its best: where its norm times the block's reaches its
    floor. Those are the first levels, so a query without hope of any is not sent at all."""
    hope = F.col("floor").isNull()
    upto = F.lit(0)
    for v in levels:
        upto = F.when(hope | (F.col("norm") * v.norm * (1 + 1e-9) + 1e-3 >= F.col("floor")), F.lit(v.last)).otherwise(upto)
    sent = asked.withColumn("_upto", F.least(upto, F.lit(stop))).where(F.col("_upto") > start)
    return sent.withColumn("cb", F.explode(F.sequence(F.lit(start), F.col("_upto") - 1))).drop("_upto")


def _meet(asked: DataFrame, rows: DataFrame, levels: list[Level], start: int, stop: int, per_task: int, quers: int, k: int) -> DataFrame:
    """The best of the blocks from start to stop for each query: the stated queries against all rows, with no pair of rows made."""
    split = max(1, math.ceil(quers / per_task))
    deal = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(split)).cast("int")
    left = to_blocks(asked, levels, start, stop).withColumns({"qb": deal, "asks": F.lit(True)})
    right = rows.where(F.col("cb").between(start, stop - 1)).withColumns({"qb": F.explode(F.sequence(F.lit(0), F.lit(split - 1))), "asks": F.lit(False), "floor": F.lit(None).cast("long")})
    columns = ["dims", "qb", "cb", "asks", "id", "mark", "floor", "v"]
    pairs = left.select(*columns).unionByName(right.select(*columns))
    tasks = max(shuffle_width(rows.sparkSession), split * (stop - start))
    return pairs.repartition(tasks, "dims", "qb", "cb").sortWithinPartitions("dims", "qb", "cb", "asks").mapInArrow(_blocks(k), BEST)


def top_k(vectors: DataFrame, asks: Column, k: int = K, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each row where asks holds, against all rows."""
    made: list[DataFrame] = []
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)) * (1 + 1e-9)
    try:
        rows = cut(rows.distinct().withColumns({"dims": F.size("v"), "mark": F.xxhash64("v"), "norm": norm}), made)
        quers = rows.where("asks").count()
        cands, levels = in_blocks(rows)
        blocks = levels[-1].last if levels else 0
        asked = rows.where("asks").withColumn("floor", F.lit(None).cast("long"))
        best = cut(_meet(asked, cands, levels, 0, 1, FIRST, quers, k), made)
        if blocks > 1:
            floors = best.groupBy(F.col("query_id").alias("id"), F.col("_qv").alias("mark")).agg(F.min("score").alias("floor"), F.count("*").alias("_n")).where(F.col("_n") >= k).drop("_n")
            best = best.union(_meet(asked.drop("floor").join(floors, ["id", "mark"], "left"), cands, levels, 1, blocks, QUERIES, quers, k))
        rank = F.row_number().over(Window.partitionBy("query_id", "_qv").orderBy(F.desc("score"), "vec_id"))
        out = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return cut(out)
    finally:
        drop_cut(*made)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
