"""Document fingerprints by context-triggered piecewise hashing, and their likeness by edit distance.

A hash of the last WINDOW bytes is taken at every byte of the UTF-8 text. A chunk ends where that hash leaves
size - 1 modulo the block size, and gives one of 64 characters from the sum of its window hashes; so an edit changes the
characters around it and moves the others. The block size is the smallest LEAST * 2 ** k that makes at most CHUNKS
chunks by the text's length. A fingerprint is `size:signature:signature at twice the size`; signatures are as long as the chunks
are many, none is cut off.

Two fingerprints are compared at every block size that both have (their sizes are equal, or one is twice the other): the
likeness is 1 - distance / longer signature, the largest of these, with Levenshtein's distance (bit-parallel). Signatures
without RUN characters in a row in common have none, as those of unrelated texts agree here and there (of signatures too
short for RUN, only equal ones are alike). Equal fingerprints have likeness 1.

`with_next` compares each document with the next by descending key: documents are dealt to range partitions and sorted
there; the first row of each partition is also sent to the one before it (the first of all to the last), so that every task has the
followers of its rows. What the driver gets is one key for each partition.

Defined results: a null text is empty; the empty text's fingerprint is `3::`, like itself alone; null keys come last, equal keys
are ordered by the hash of their texts; a table of one row is followed by itself; an empty table gives no rows; other columns
aren't read. Texts may have any length; a task holds two at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .common import lean, shuffle_width, table

WINDOW, LEAST, CHUNKS, RUN = 7, 3, 64, 3
CHARACTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once: bounds the memory that a very long text takes.
STEP = 1 << 18


def block_size(n_bytes: int) -> int:
    size = LEAST
    while size * CHUNKS < n_bytes:
        size *= 2
    return size


def window_hashes(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """64-bit hashes of the WINDOW bytes that end at each byte; before: the WINDOW - 1 bytes in front."""
    wide = np.concatenate([before, data]).astype(np.uint64)
    h = np.zeros(len(data), np.uint64)
    for i in range(WINDOW):
        h = h * MIX + wide[i : i + len(data)] + np.uint64(1)
    h ^= h >> np.uint64(32)
    h *= MIX
    return h ^ (h >> np.uint64(29))


def _signature(sums: np.ndarray) -> str:
    return CHARACTERS[((sums * MIX) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def _chunk_sums(h: np.ndarray, size: int, total: np.uint64) -> tuple[np.ndarray, np.uint64]:
    """Sums of the chunks that end in h, and of the one left open; total: the open chunk's so far."""
    ends = np.flatnonzero(h % np.uint64(size) == np.uint64(size - 1)) + 1
    run = np.cumsum(h, dtype=np.uint64)
    at = run[ends - 1] + total if len(ends) else run[:0]
    sums = np.diff(at, prepend=np.uint64(0)) if len(ends) else at
    last = run[-1] + total
    return sums, last - at[-1] if len(ends) else last


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = block_size(len(data))
    parts: dict[int, list[np.ndarray]] = {size: [], 2 * size: []}
    open_ = {s: np.uint64(0) for s in parts}
    ended = {s: True for s in parts}  # whether the text so far ends with a chunk's end
    before = np.zeros(WINDOW - 1, np.uint8)
    with np.errstate(over="ignore"):
        for i in range(0, len(data), STEP):
            piece = data[i : i + STEP]
            h = window_hashes(piece, before)
            before = np.concatenate([before, piece])[-(WINDOW - 1) :]
            for s in parts:
                sums, open_[s] = _chunk_sums(h, s, open_[s])
                parts[s].append(sums)
                ended[s] = h[-1] % np.uint64(s) == np.uint64(s - 1)
        signs = [_signature(np.concatenate([*parts[s], *([] if ended[s] else [np.array([open_[s]], np.uint64)])])) if parts[s] else "" for s in parts]
    return f"{size}:{signs[0]}:{signs[1]}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein's distance, a column of the table at a time in the bits of two integers."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)
    for c in b:
        same = where.get(c, 0)
        across = (((same & up) + up) ^ up) | same | down
        plus, minus = down | ~(across | up) & full, up & across
        distance += (plus & top > 0) - (minus & top > 0)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        same |= down
        up, down = minus | ~(same | plus) & full, plus & same
    return distance


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
    if not any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1)):
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1."""
    if a == b:
        return 1.0
    (size_a, *sign_a), (size_b, *sign_b) = a.split(":"), b.split(":")
    of_a = {int(size_a) * m: s for m, s in zip((1, 2), sign_a, strict=True)}
    of_b = {int(size_b) * m: s for m, s in zip((1, 2), sign_b, strict=True)}
    return max((_alike(of_a[s], of_b[s]) for s in of_a.keys() & of_b.keys()), default=0.0)


def edited(text: str, other: str) -> str:
    """text with its last half (whole characters, rounded down) replaced by as many of other's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


@F.pandas_udf(StringType())
def fingerprint_of(text: pd.Series) -> pd.Series:
    return text.map(lambda t: fingerprint(t or ""))


@F.pandas_udf(DoubleType())
def likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_key, _text, _guest: each partition holds its rows by descending key, then the rows that begin the next partition as guests."""
    dealt = docs.select(F.col(key).alias("_key")).where("_key is not null").repartitionByRange(shuffle_width(docs.sparkSession), F.col("_key").desc())
    heads = np.array(sorted(r.head for r in dealt.groupBy(F.spark_partition_id()).agg(F.max("_key").alias("head")).collect()))
    parts = max(len(heads), 1)

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        at, first = np.full(len(keys), parts - 1), np.zeros(len(keys), bool)  # nulls: at the end
        if len(heads):
            mine = keys[known].to_numpy().astype(heads.dtype)
            above = np.searchsorted(heads, mine, side="left")  # the smallest head that isn't below the key
            at[known], first[known] = parts - 1 - above, heads[above] == mine
        elif len(keys):
            first[:] = True
        return pd.Series([[a, (a - 1) % parts] if f else [a] for a, f in zip(at.tolist(), first, strict=True)])

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).withColumn("_places", places("_key"))
    rows = rows.select("_key", "_text", F.posexplode("_places").alias("_guest", "_part"))
    return rows.repartitionById(parts, "_part").sortWithinPartitions("_guest", F.col("_key").desc_nulls_last(), F.xxhash64("_text")).drop("_part")


COMPARED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each that isn't a guest, with the one after it."""
    names = ["_key", *[c.split()[0] for c in COMPARED.split(", ")]]
    held: tuple | None = None
    for b in batches:
        out: list[list] = [[] for _ in names]
        for key, text, guest in zip(b["_key"], b["_text"].to_pylist(), b["_guest"].to_pylist(), strict=True):
            own = (key, text, fingerprint(text))
            if held:
                other = edited(held[1], text)
                print_ = fingerprint(other)
                row = (held[0].as_py(), len(held[1]), hashlib.sha256(other.encode()).hexdigest(), held[2], print_, likeness(held[2], print_), likeness(held[2], own[2]))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            held = None if guest else own
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b["_key"].type), *[pa.array(x) for x in out[1:]]], names=names)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row: the edited text takes its
    last half from the next row's beginning; likeness to the edited text's fingerprint, and to the next row's."""
    rows = in_order(docs, key, text)
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(lean(_compare), f"_key {kind}, {COMPARED}").withColumnRenamed("_key", key)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents"))
