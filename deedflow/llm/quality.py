"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each whole text becomes a vector of document statistics (STATS). Random Fourier features approximate a Gaussian
kernel over the standardised statistics; every partition sums its part of the normal equations, the parts are
added, and one small solve gives ridge weights. A fifth of the labelled rows, kept out of the solve, calibrates:
pool-adjacent-violators over a histogram of ridge scores gives a monotone, piecewise-linear probability.

The model has fixed size (FEATURES squared), whatever the corpus; statistics, standardisation, normal equations and
histogram run over all labelled rows, in partitions. The statistics are written once to the shared folder and read
by the fit and by the scoring.

Defined results: null and empty texts have all statistics 0 and are scored like any other; repeated documents get a
row each; labels that are null or of no document don't count; a null id is in no fold held out and has no label; equal statistics
get equal scores; without labelled rows every score is 0.5. The rows of the fit calibrate
too, each with the weight 1 / (1 + (n / FEW) ** 2), n being the rows of the calibration fifth: whole without any, little beside many. A document
with several labels counts once for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec
from .common import cut, lean, small_batches, table

STATS = (
    "log_bytes log_words word_mean word_sd word_max distinct_words top_word distinct_4grams letters upper digits spaces punct symbols sentence_ends commas "
    "non_ascii controls lines line_mean repeated_lines ends_stop entropy starts_upper mixed_words"
).split()
FEATURES, WIDTH, RIDGE, SEED, BINS = 384, 1.6, 1e-3, 11, 400
PREDICT_AT, FEW = 0.3, 40
CLASS = np.zeros(256, np.int64)  # 0 control, 1 lower, 2 upper, 3 digit, 4 space, 5 punctuation, 6 symbol, 7 non-ASCII
for _i in range(256):
    _c = chr(_i)
    CLASS[_i] = 7 if _i > 127 else 1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if _c.isdigit() else 4 if textvec.SPACE[_i] else 5 if _c in ".,;:!?'\"()-" else 6 if 32 < _i < 127 else 0


def _distinct(n: int, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each of n documents: distinct hashes, and how often its most frequent one comes."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, doc))
    d, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]))
    runs = np.diff(np.append(new, len(h)))
    top = np.zeros(n)
    np.maximum.at(top, d[new], runs)
    return np.bincount(d[new], minlength=n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATS per document."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    over = lambda a, b: a / np.maximum(b, 1)
    kinds = np.bincount(doc * 8 + CLASS[data], minlength=n * 8).reshape(n, 8)
    seen = np.bincount(doc * 256 + data, minlength=n * 256).reshape(n, 256)
    p = over(seen, size[:, None])
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    h, wd, ws, wl = textvec.words(data, offsets)
    count = np.bincount(wd, minlength=n)
    mean = over(np.bincount(wd, wl, n), count)
    sd = np.sqrt(np.maximum(over(np.bincount(wd, wl.astype(float) ** 2, n), count) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, wd, wl)
    distinct, top = _distinct(n, wd, h)
    grams = textvec.shingle(h, 4)
    inside = wd[: len(grams)] == wd[3:] if len(grams) else np.zeros(0, bool)
    distinct4, _ = _distinct(n, wd[: len(grams)][inside], grams[inside])
    lh, ld, ls, ll = textvec.hashes(data, offsets, data != 10)
    lines = np.bincount(ld, minlength=n)
    distinct_lines, _ = _distinct(n, ld, lh)
    last = np.bincount(ld, data[ls + ll - 1] == 46, n) if len(lh) else np.zeros(n)
    first = np.bincount(wd, CLASS[data[ws]] == 2, n) if len(ws) else np.zeros(n)
    kind = CLASS[data]
    other = np.concatenate([[0], np.cumsum((kind == 3) | (kind == 6))])
    mixed = np.bincount(wd, other[ws + wl] > other[ws], n) if len(ws) else np.zeros(n)
    return np.column_stack([
        np.log1p(size), np.log1p(count), mean, sd, np.log1p(longest), over(distinct, count), over(top, count), over(distinct4, np.maximum(count - 3, 1)),
        *(over(kinds[:, k], size) for k in (1, 2, 3, 4, 5, 6)), over(seen[:, [33, 46, 63]].sum(axis=1), count), over(seen[:, 44], count),
        over(kinds[:, 7], size), over(kinds[:, 0], size), np.log1p(lines), np.log1p(over(size, lines)), 1 - over(distinct_lines, np.maximum(lines, 1)) * (lines > 0) - (lines == 0),
        over(last, lines), entropy, over(first, count), over(mixed, count),
    ])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [statistics(d, o) for _, d, o in textvec.groups(batch.column(batch.num_columns - 1))]
        got = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, len(STATS)), np.float32)
        stats = pa.FixedSizeListArray.from_arrays(pa.array(got.ravel()), len(STATS)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], stats], names=[*batch.schema.names[:-1], "stats"])


def document_statistics(docs: DataFrame, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the array stats of every row."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(lean(_measure), f"{schema}, stats array<float>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """1 and the random Fourier features of standardised statistics."""
        rnd = np.random.default_rng(SEED)
        w = rnd.normal(size=(len(STATS), FEATURES)) / (WIDTH * math.sqrt(len(STATS)))
        z = np.clip((stats - self.mean) / self.scale, -8, 8) @ w + rnd.uniform(0, 2 * math.pi, FEATURES)
        return np.column_stack([np.ones(len(z)), math.sqrt(2 / FEATURES) * np.cos(z)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.knots is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), *self.knots), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), len(STATS))


def _equations(model: Model):
    """Sums of a partition's part of the normal equations: (cell, value) of [Z y]'[Z y]."""

    def run(batches):
        total = np.zeros((FEATURES + 2, FEATURES + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                z = np.column_stack([model.features(_matrix(part.column(0))), part.column(1).to_numpy()])
                total += z.T @ z
        cells = np.flatnonzero(np.triu(np.ones(total.shape, bool)).ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells])], names=["cell", "value"])

    return run


def isotonic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted places x with n rows and y positives: (places, values) to interpolate."""
    blocks: list[list[float]] = []  # rows, positives, sum of places
    for a, b, c in zip(x, n, y, strict=True):
        blocks.append([b, c, a * b])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def train(stats: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", label: str = "quality") -> Model:
    """Fit on the rows of stats (key, stats) where learn holds and labels has a label."""
    rows = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("_key"), (F.col(label) > 0).cast("double").alias("y"))
    known = stats.where(learn).join(rows, F.col(key) == F.col("_key")).select("stats", "y", (F.pmod(F.xxhash64(key, F.lit(5)), F.lit(5)) == 0).alias("held"))
    aggregates = [f(F.col("stats")[i]) for i in range(len(STATS)) for f in (F.avg, F.stddev_pop)]
    first = known.agg(F.count("*"), *aggregates).first()
    if not first[0]:
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)))
    sd = np.array(first[2::2], float)
    model = Model(np.array(first[1::2], float), np.where(sd > 1e-6, sd, 1.0))
    sums = known.where(~F.col("held")).select("stats", "y").mapInArrow(lean(_equations(model)), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    if not sums:
        return model
    side = FEATURES + 2
    total = np.zeros(side * side)
    total[[r[0] for r in sums]] = [r[1] for r in sums]
    total = total.reshape(side, side)
    total = total + np.triu(total, 1).T
    z, y = total[:-1, :-1], total[:-1, -1]
    n = max(z[0, 0], 1.0)
    penalty = np.full(side - 1, RIDGE * n)
    penalty[0] = 1e-9 * n
    model.weights = np.linalg.solve(z + np.diag(penalty + 1e-9), y)

    def histogram(batches):
        for batch in batches:
            bins = np.clip(np.floor((model.raw(_matrix(batch.column(0))) + 1) / 3 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "y"])

    def counted(rows):
        return sorted(map(tuple, rows.select("stats", "y").mapInArrow(lean(histogram), "bin int, y double").groupBy("bin").agg(F.count("*"), F.sum("y")).collect()))

    # Rows of the fit count the less, the more rows there are that it hasn't seen.
    apart, fitted = counted(known.where("held")), counted(known.where(~F.col("held")))
    weight = 1 / (1 + (sum(n for _, n, _ in apart) / FEW) ** 2)
    bins: dict[int, np.ndarray] = {}
    for part, w in ((apart, 1.0), (fitted, weight)):
        for b, n, y in part:
            bins[b] = bins.get(b, np.zeros(2)) + w * np.array([n, y])
    b, (n, y) = np.array(sorted(bins), float), np.array([bins[x] for x in sorted(bins)]).T
    model.knots = isotonic((b + 0.5) / BINS * 3 - 1, n, y)
    return model


def predict(stats: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.select(*kept).schema)

    def run(batches):
        for batch in batches:
            got = [model.score(_matrix(batch.column(len(kept)).slice(at, 4096))) for at in range(0, batch.num_rows, 4096)]
            score = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= PREDICT_AT).astype(np.int32))], names=[*kept, "score", "predicted"])

    return stats.select(*kept, "stats").mapInArrow(lean(run), f"{schema}, score double, predicted int")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    with small_batches(spark):
        stats = cut(document_statistics(docs.select("doc_id", held.alias("held_out"), "text"), ["doc_id", "held_out"]))
    model = train(stats, table(spark, sf_dir, "labels"), ~F.col("held_out"))
    return predict(stats, model, ["doc_id", "held_out"])
