"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text is the average of the embeddings of its hashed byte n-grams (A-Z lowered, runs of other ASCII
non-letters as one boundary each byte); a linear softmax over the average gives the language. Embedding and
softmax multiply into one (buckets x languages) table after training, so scoring a text adds table rows.
Rows that training doesn't see calibrate (CALIBRATION and a fifth of SAMPLE expected at most; a fifth of a small table):

- a temperature for the probabilities, by cross-entropy against smoothed labels (n + 1 of n + 2 right), so it stays finite
  where every row is right;
- an open-set score: the mean log share that the text's n-grams have in the training texts of the predicted language,
  as a deviation from that of the language's calibration rows, over a spread that shrinks with the text's n-grams.

A text is rejected where its language is likelier wrong than right, or where it is novel (random letters, languages that
weren't learned): its deviation is below both -LEAST and the QUANTILE of the calibration rows, and its mean has come FAR
of the way from the language's mean to that of n-grams drawn uniformly. Both bars are for any number of calibration rows: with n of
them the first is n / (n + DOUBT) of one half, and the second moves out as 1 + DOUBT / n, since few rows say little of rare clean texts.

Training and calibration use a sample of labelled rows, chosen by a hash of their id; everything else reads every
whole text.

Of fewer than five labelled rows all train, and neither temperature nor rejection is fitted.

Defined results: a null text or one without a letter is `und` with score 0 and is rejected; a null id is in no fold held out and
is learned from like others; repeated rows get a row each; equal scores go to the first language by name; without labelled rows
every prediction is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec
from .common import cut, drop_cut, lean, small_batches, table

SAMPLE, BUCKETS, DIM, EPOCHS, RATE = 2500, 1 << 15, 16, 8, 12.0
CALIBRATION, QUANTILE, LEAST, FAR, DOUBT = 5000, 0.001, 4.0, 0.25, 50
RARE, LANGUAGES = 100, 1000
ORDERS = (2, 3, 4)
SEGMENT = 1 << 18
#: Other ASCII bytes than letters are one symbol.
SYMBOL = textvec.LOWER.astype(np.uint32)
SYMBOL[[i for i in range(128) if not chr(i).isalpha()]] = 32


def ngrams(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, bucket at each start) for each order."""
    h = np.zeros(len(symbols), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(symbols) - n + 1] * np.uint32(0x01000193) ^ symbols[n - 1 :] if len(symbols) >= n else h[:0]
        if n in ORDERS:
            yield n, ((h * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)


def sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, text -> label, distinct buckets, their share of the text's n-grams and the number of these."""
    for batch in batches:
        labels, rows = batch.column(0).to_pylist(), []
        data, offsets = textvec.flat(batch.column(1))
        for i, label in enumerate(labels):
            total = np.zeros(BUCKETS, np.int64)
            for at in range(offsets[i], offsets[i + 1], SEGMENT):
                symbols = SYMBOL[data[at : min(at + SEGMENT + max(ORDERS) - 1, offsets[i + 1])]]
                for _, b in ngrams(symbols):
                    total += np.bincount(b[:SEGMENT], minlength=BUCKETS)
            idx = np.flatnonzero(total)
            if len(idx):
                rows.append({"label": label, "idx": idx.astype(np.int32).tobytes(), "share": (total[idx] / total.sum()).astype(np.float32).tobytes(), "n": int(total.sum())})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("label", pa.string()), ("idx", pa.binary()), ("share", pa.binary()), ("n", pa.int64())]))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x languages, divided by the temperature
    bias: np.ndarray
    reject_below: float
    shares: np.ndarray | None = None  # buckets x languages, log; None: no open-set score
    usual: np.ndarray | None = None  # languages x (mean, spread between texts, spread of one n-gram)
    least: float = -np.inf

    def novel(self, mean: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        mu, uniform = self.usual[lang, 0], self.shares.mean(axis=0)[lang]
        return (n > 0) & (self.deviation(mean, n, lang) < self.least) & (mean < mu - FAR * (mu - uniform))

    def deviation(self, mean: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Of texts of n n-grams with these mean log shares, in deviations of the language."""
        mu, between, within = self.usual[lang].T
        return (mean - mu) / np.sqrt(between + within / np.maximum(n, 1))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits z with the least cross-entropy against smoothed labels y."""
    n, c = z.shape
    goal = np.full((n, c), 1 / (n + 2) / max(c - 1, 1))
    goal[np.arange(n), y] = (n + 1) / (n + 2)

    def loss(t):
        x = z / t - (z / t).max(axis=1, keepdims=True)
        return (goal * (np.log(np.exp(x).sum(axis=1, keepdims=True)) - x)).sum()

    return float(min(np.geomspace(1e-3, 1e3, 241), key=loss))


def spreads(off: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(between texts, of one n-gram): squared deviations by least squares on 1 and 1 / n, weighted by n, none negative."""
    w, x, y = np.sqrt(n), 1 / n, off**2
    tiny = max(1e-6, 1e-3 * float((y * n).mean()))
    (a, b), *_ = np.linalg.lstsq(np.stack([w, w * x], axis=1), w * y, rcond=None)
    if a < 0:
        a, b = 0.0, float(y.sum() / x.sum())
    if b < 0:
        a, b = float(y.mean()), 0.0
    return max(a, 1e-6), max(b, tiny)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Per-row SGD on the cross-entropy, the rate falling linearly; log shares of n-grams by language. Not calibrated."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    rnd = np.random.default_rng(seed)
    place = {x: i for i, x in enumerate(langs)}
    emb = rnd.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    out, bias = np.zeros((len(langs), DIM), np.float32), np.zeros(len(langs), np.float32)
    steps, t = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rnd.permutation(len(rows)):
            label, idx, share, _ = rows[i]
            rate = RATE * (1 - t / steps)
            avg = share @ emb[idx]
            err = softmax(out @ avg + bias)
            err[place[label]] -= 1
            back = err @ out
            out -= np.float32(rate / 8) * np.outer(err, avg)
            bias -= np.float32(rate / 100) * err
            emb[idx] -= np.float32(rate) * np.outer(share, back)
            t += 1
    seen = np.full((BUCKETS, len(langs)), 0.5)
    for label, idx, share, n in rows:
        seen[idx, place[label]] += share * n
    return Model(langs, emb @ out.T, bias, 0.0, np.log(seen / seen.sum(axis=0)).astype(np.float32))


def calibrate(model: Model, y: np.ndarray, z: np.ndarray, means: np.ndarray, n: np.ndarray) -> Model:
    """model with a temperature and rejection, from rows that it wasn't fitted on: their languages, logits, mean log shares by
    language and numbers of n-grams."""
    if not len(y):
        return replace(model, shares=None)
    temp = temperature(z, y)
    sure = 0.5 * len(y) / (len(y) + DOUBT)
    model = replace(model, table=(model.table / temp).astype(np.float32), bias=model.bias / temp, reject_below=sure if len(model.langs) > 1 else 0.0)
    top, model.usual = z.argmax(axis=1), np.zeros((len(model.langs), 3))
    mean = means[np.arange(len(top)), top]
    for k in range(len(model.langs)):
        own = top == k if (top == k).sum() >= 20 else np.ones(len(top), bool)  # too few: as over all languages
        mu = float((mean[own] * n[own]).sum() / n[own].sum())
        model.usual[k] = mu, *spreads(mean[own] - mu, n[own])
    model.least = min(-LEAST, float(np.quantile(model.deviation(mean, n, top), QUANTILE, method="lower"))) * (1 + DOUBT / len(y))
    return model


def score_batches(model: Model, kept: list[str]):
    """Scorer of batches (kept..., text, has a letter)."""

    def run(batches):
        # One table of both, so that a text's n-grams are looked up once.
        grid = model.table if model.shares is None else np.concatenate([model.table, model.shares], axis=1)
        for batch in batches:
            data, offsets = textvec.flat(batch.column(len(kept)))
            letter = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False).astype(bool)
            n, c = len(letter), len(model.langs)
            total, count = np.zeros((n, grid.shape[1])), np.zeros(n)
            longest = max(ORDERS) - 1
            for at in range(int(offsets[0]), int(offsets[-1]), SEGMENT):
                end = min(at + SEGMENT + longest, int(offsets[-1]))
                symbols = SYMBOL[data[at:end]]
                a = int(np.searchsorted(offsets, at, "right")) - 1
                b = int(np.searchsorted(offsets, min(at + SEGMENT, int(offsets[-1])), "left"))
                lo = np.maximum(offsets[a:b], at)
                for order, bucket in ngrams(symbols):
                    hi = np.minimum(np.minimum(offsets[a + 1 : b + 1] - order + 1, at + SEGMENT), at + len(bucket))
                    some = np.flatnonzero(hi > lo)
                    if not len(some):
                        continue
                    # sums over [lo, hi) of each text: every other slice of reduceat
                    cuts = np.empty(2 * len(some), np.int64)
                    cuts[::2], cuts[1::2] = lo[some] - at, hi[some] - at
                    part = np.add.reduceat(np.concatenate([grid[bucket], np.zeros((1, grid.shape[1]), np.float32)]), cuts, axis=0, dtype=np.float64)[::2]
                    total[a + some] += part
                    count[a + some] += hi[some] - lo[some]
            ok = letter & (c > 0)  # a single byte has no n-gram: the bias alone decides
            lang, score = np.full(n, "und", object), np.zeros(n)
            if ok.any():
                mean = total[ok] / np.maximum(count[ok, None], 1)
                p = softmax(mean[:, :c] + model.bias)
                top = p.argmax(axis=1)
                lang[ok], score[ok] = np.array(model.langs, object)[top], p.max(axis=1)
            rejected = ~ok | (score < model.reject_below)
            if ok.any() and model.shares is not None:
                rejected[ok] |= model.novel(mean[np.arange(len(top)), c + top], count[ok], top)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*kept, "lang_pred", "score", "rejected"])

    return run


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """Fit and calibrate on rows of docs where learn holds and the label isn't null.

    A hash of the id chooses sample + CALIBRATION of them, and RARE of each language at least (expected; all, if fewer). Four fifths
    of sample, by a hash of what they hold, train, and the others calibrate; the driver gets no more of their n-grams
    than those of the training rows. Of more than `languages` labels, the most frequent are learned: the model has
    a column for each, so this bounds its size."""
    usable = docs.where(learn & F.col(lang).isNotNull()).withColumn("_lang", F.col(lang).cast("string"))
    counts = {r[0]: r[1] for r in usable.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(languages).collect()}
    if not counts:
        return fit([])
    usual = (sample + CALIBRATION) / sum(counts.values())
    rates = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, int(min(1.0, max(usual, RARE / n)) * (1 << 30)))])
    chosen = usable.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) < F.try_element_at(rates, F.col("_lang"))).where(F.col(text).rlike(r"\p{L}"))
    rows = cut(chosen.select("_lang", F.col(text)).mapInArrow(lean(sparse_rows), "label string, idx binary, share binary, n long").withColumn("_order", F.xxhash64("label", "idx", "share", F.lit(7))))
    total = rows.count()
    size = min(total, sample) - min(total, sample) // 5
    # The place of the last training row first, from the order alone; of rows that hold the same, any may be left out.
    last = rows.select("_order").orderBy("_order").limit(size).agg(F.max("_order")).first()[0]
    got = sorted(rows.where(F.col("_order") <= F.lit(last)).limit(size).collect(), key=lambda r: (r._order, r.label, bytes(r.idx)))
    model = fit([(r.label, np.frombuffer(r.idx, np.int32), np.frombuffer(r.share, np.float32), r.n) for r in got])
    place, grid = {x: i for i, x in enumerate(model.langs)}, np.concatenate([model.table, model.shares], axis=1) if got else None

    def measured(batches):
        for batch in batches:
            found = [np.frombuffer(s.as_py(), np.float32) @ grid[np.frombuffer(i.as_py(), np.int32)] for i, s in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(found, pa.list_(pa.float32()))], names=["label", "n", "sums"])

    held = []
    if total > size:
        apart = rows.where((F.col("_order") > got[-1]._order) & F.col("label").isin(model.langs)).drop("_order").mapInArrow(lean(measured), "label string, n long, sums array<float>")
        held = apart.orderBy(F.xxhash64("label", "n", "sums")).limit(sample + CALIBRATION).collect()
    drop_cut(rows)
    c = len(model.langs)
    sums = np.array([r.sums for r in held], np.float64).reshape(len(held), 2 * c)
    return calibrate(model, np.array([place[r.label] for r in held], int), sums[:, :c] + model.bias, sums[:, c:], np.array([r.n for r in held], np.float64))


def predict(docs: DataFrame, model: Model, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns, lang_pred, score and rejected of every row."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    read = docs.select(*kept, F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    return read.mapInArrow(lean(score_batches(model, kept)), f"{schema}, lang_pred string, score double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    with small_batches(spark):
        model = train(docs.select("doc_id", "text", "lang"), ~held)
        scored = cut(predict(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"]))
    return scored.select("doc_id", "held_out", "lang_pred", "score", "rejected")
