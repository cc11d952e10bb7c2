"""Vectorised text scanning over Arrow string columns: numpy on the UTF-8 bytes, no per-word Python.

Documents are taken in groups of about GROUP bytes, so that memory follows the group (or the longest single
document) and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP = 1 << 18
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
#: The first n of eight bytes.
TAIL = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
#: So many runs, at most, are hashed one by one instead of chunk by chunk.
LONG_RUNS = 4
#: \x20 and \x09-\x0D
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte to itself
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def groups(column: pa.Array, limit: int = GROUP) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first document, bytes, offsets from 0) of runs of documents of about limit bytes together."""
    data, offsets = flat(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        end = min(end, n, at + 8192)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes where inside holds, cut at documents: (hash, document, start, length) of each.

    A run is hashed by its chunks of eight bytes, read in place: the sum of their mixed values, each with its number."""
    size = len(data)
    if not size or not inside.any():
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    cut = offsets[(offsets > 0) & (offsets < size)]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cut] = inside[cut]
    ends[:-1] &= ~inside[1:]
    ends[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    eight = np.ndarray((size,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    total = mix((eight[starts] & TAIL[np.minimum(lengths, 8)]) + np.uint64(BASE))
    more, chunk = np.flatnonzero(lengths > 8), 1
    while len(more) > LONG_RUNS:
        at, left = starts[more] + 8 * chunk, lengths[more] - 8 * chunk
        chunk += 1
        total[more] += mix((eight[at] & TAIL[np.minimum(left, 8)]) + np.uint64(chunk * BASE & MASK))
        more = more[left > 8]
    for i in more.tolist():  # a few long runs: each at once
        at, left = np.arange(starts[i] + 8 * chunk, starts[i] + lengths[i], 8), np.arange(lengths[i] - 8 * chunk, 0, -8)
        number = np.arange(chunk + 1, chunk + 1 + len(at)).astype(np.uint64)
        total[i : i + 1] += mix((eight[at] & TAIL[np.minimum(left, 8)]) + number * np.uint64(BASE)).sum()
    docs = np.diff(np.searchsorted(starts, offsets))
    return mix(total ^ (lengths.astype(np.uint64) << np.uint64(48))), np.repeat(np.arange(len(docs)), docs), starts, lengths


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of A-Z-lowered bytes: (hash, document, start, length)."""
    return hashes(LOWER[data], offsets, ~SPACE[data])


def shingle(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (the last k - 1 positions are left out)."""
    n = max(0, len(word) - k + 1)
    out = word[:n].copy()
    for i in range(1, k):
        out *= np.uint64(BASE)
        out += word[i : i + n]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of every document's distinct k-word shingles, sorted; a document of fewer words,
    but not none, has its whole sequence as one."""
    return counted_sets(data, offsets, k)[:2]


def counted_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """shingle_sets(), and the number of words of each document."""
    word, doc, _, _ = words(data, offsets)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    if not len(word):
        return doc, word, count
    at = np.cumsum(count) - count
    got = shingle(word, k)
    inside = np.ones(len(word), bool)
    for i in range(1, k):  # the last k - 1 words of a document begin no shingle
        inside[(at + count - i)[count >= i]] = False
    size = np.maximum(count - k + 1, 0)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = [mix(shingle(word[at[d] : at[d] + count[d]], int(count[d])) ^ np.uint64(count[d]))[0] for d in short]
        got = np.append(got, np.zeros(k - 1, np.uint64))
        got[at[short]] = whole
        inside[at[short]] = True
        size[short] = 1
    else:
        inside = inside[: len(got)]
    hs = got[: len(inside)][inside]
    end = np.cumsum(size)
    for a, b in zip((end - size).tolist(), end.tolist(), strict=True):
        hs[a:b].sort()
    ds = np.repeat(np.arange(len(size)), size)
    keep = np.ones(len(hs), bool)
    keep[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
    return ds[keep], hs[keep], count
