r"""N-gram Jaccard join: exact components of documents whose shingle sets are similar, by set-relation skipping.

Sets that are equal are one node from the start (their documents link without a comparison). Between nodes it is a
prefix-filtered index join with these parts:

- a global order of shingles, rare ones first: by a count sketch of fixed size over all documents, then by hash. Any
  fixed order gives exact results; this one keeps shared passages out of the prefixes;
- an index: for each shingle, the list of nodes that have it in their prefix, with set size and position, in the order of
  positions and in blocks of LIST_BLOCK that know their least position and their range of sizes. Lists of one node are dropped in
  the task that finds them;
- stars: each list's HUBS nodes of smallest hash are compared with the list: blocks without room for a similar set are skipped whole,
  then postings whose sizes and positions leave no room, then pairs whose parity
  bitmaps (their Hamming distance is a lower bound of the symmetric difference) don't exclude the pair;
- skipping: afterwards a list whose nodes are in one component is done, and a pair in one component is never looked at;
- longer lists that are still open meet as cells (see open_cells), in blocks of bounded nodes and bytes: first bitmaps, which leave
  the nodes that have a candidate in another component, then their sets. There a set's answers, the
  numbers of shingles in common with all others, are derived from those of a similar set computed before, by the
  difference of the two (Overlaps); sets whose candidates are all in their own component are skipped.

All links are verified on whole sets. The pairs of an open cell stay in their task: it gives out a link only where that joins two
components, fewer than it has nodes. A large group of near copies costs its square only in answers compared inside tasks, and
only while it isn't one component; rows, shuffles and memory follow its size (shuffles: times its number of blocks).

Sets are told apart, and shingles compared, by 64-bit hashes. Defined results: null and empty texts and texts
without words have an empty set, link with nothing and are their own component; a text with fewer words than a shingle has
its whole sequence as one; repeated rows get a row each; a component's id is its smallest non-null id.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textvec
from .common import bounded, cut, dropping, lean, shuffle_width, small_batches, table
from .components import components

CELLS, CHUNKS = 1 << 23, 64
HUBS, BITS, LIST_BLOCK = 12, 1024, 64
#: Nodes, and bytes of their sets, of a block.
BLOCK, BLOCK_BYTES = 4096, 8 << 20
#: Tables of so many bytes at most (8 for each long) are broadcast.
BROADCAST_BYTES = 8 << 20
#: Sketches that are added up at once.
FAN = 64
POSTING = np.dtype([("token", "u8"), ("node", "i8"), ("size", "u4"), ("pos", "u4")])
BATCH_POSTINGS, PART_POSTINGS = 1 << 18, 1 << 20


def need(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection at which sets of sizes a and b are similar enough."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size + (-percent * size // 100) + 1


def near(df: DataFrame) -> DataFrame:
    """df, a table of ids, marked for broadcast if it is small."""
    return bounded(df, BROADCAST_BYTES // (8 * len(df.columns)))


# --- passes over the texts ---------------------------------------------------------------------------------------


def set_ids(doc: np.ndarray, shingles: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, id) of each of n documents' sets."""
    size = np.bincount(doc, minlength=n)
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        out[some] = np.add.reduceat(textvec.mix(shingles + np.uint64(textvec.BASE)), (np.cumsum(size) - size)[some])
    return size, textvec.mix(out ^ size.astype(np.uint64)).view(np.int64)


def cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int32)


def _heads(k: int):
    """id, any columns, text -> id, those columns, words, n, node of every document; at the end the task's part of the sketch, in
    chunks."""

    def run(batches):
        sketch, fields, names = np.zeros(CELLS, np.uint32), [], []
        for batch in batches:
            kept = batch.columns[:-1]
            fields, names = [c.type for c in kept], [*batch.schema.names[:-1], "words", "n", "node", "chunk", "sketch"]
            counts, sizes, nodes = [], [], []
            for _, data, offsets in textvec.groups(batch.column(batch.num_columns - 1)):
                doc, hs, count = textvec.counted_sets(data, offsets, k)
                size, node = set_ids(doc, hs, len(offsets) - 1)
                counts.append(count)
                sizes.append(size)
                nodes.append(node)
                np.add.at(sketch, cells(hs), np.uint32(1))
            if sizes:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(np.concatenate(x)) for x in (counts, sizes, nodes)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        if sketch.any():
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(sketch, CHUNKS)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(CHUNKS, t) for t in [*fields, pa.int64(), pa.int64(), pa.int64()]), pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(part), np.uint32).astype(np.int64)
            sums[chunk] = sums.get(chunk, 0) + counts
    return sums


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, sketch -> one sketch for each chunk; counts stay at their greatest value."""
    for chunk, counts in _sums(batches).items():
        blob = zlib.compress(np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "sketch": pa.array([blob], pa.binary())})


def _merged(usual: float):
    """chunk, sketch -> chunk and the frequency class of each of its cells, summed as a stream."""

    def run(batches):
        for chunk, counts in _sums(batches).items():
            level = np.clip(np.floor(2 * np.log2(np.maximum(counts, 1) / (2 * usual))), 0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "level": pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())})

    return run


def gathered(sketches: DataFrame, width: int) -> DataFrame:
    """chunk, sketch of all tasks -> fewer of each chunk: added up in groups of tasks, so that nobody reads those of all of them."""
    tasks = sketches.where("chunk = 0").count()
    while tasks > FAN:
        groups = -(-tasks // FAN)
        each = sketches.withColumn("_g", F.pmod(F.xxhash64("sketch"), F.lit(groups)))
        sketches = each.repartition(min(groups * CHUNKS, max(width, CHUNKS)), "chunk", "_g").drop("_g").mapInArrow(lean(_added), "chunk int, sketch binary")
        tasks = groups
    return sketches


def splits(level: np.ndarray, usual: float) -> np.ndarray:
    """Into how many parts, at least, the list of a shingle of this frequency class is split by node."""
    return np.maximum(2 ** ((level.astype(np.float64) + 1) / 2) * 2 * usual / PART_POSTINGS, 1).astype(np.uint64)


def _postings(k: int, percent: int, levels, usual: float, parts: int):
    """text -> packed prefix postings, for each part of the shingle space; each set once in a task. Lists that a part may not
    hold are split by node."""

    def run(batches):
        seen: set[int] = set()
        waiting, held = [], 0

        def flush():
            every = np.concatenate(waiting)
            by_node = textvec.mix(every["node"].view(np.uint64)) % splits(levels.value[cells(every["token"])], usual)
            part = (textvec.mix(every["token"] + by_node) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            every, part = every[order], part[order]
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            blobs = [every[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(every)], strict=True)]
            return pa.RecordBatch.from_pydict({"part": pa.array(part[cuts]), "blob": pa.array(blobs, pa.binary())})

        for batch in batches:
            for _, data, offsets in textvec.groups(batch.column(0)):
                doc, hs = textvec.shingle_sets(data, offsets, k)
                size, node = set_ids(doc, hs, len(offsets) - 1)
                end, level, fresh, front = np.cumsum(size), levels.value[cells(hs)], [], []
                length = prefix(size, percent)
                for i, x in enumerate(node.tolist()):
                    if size[i] and x not in seen:
                        seen.add(x)
                        fresh.append(i)
                        at = end[i] - size[i]
                        # The set is in the order of hashes; a stable sort by class gives the global order.
                        front.append(at + level[at : end[i]].argsort(kind="stable")[: length[i]])
                if not fresh:
                    continue
                length, front = length[fresh], np.concatenate(front)
                out = np.empty(len(front), POSTING)
                out["token"], out["node"], out["size"] = hs[front], np.repeat(node[fresh], length), np.repeat(size[fresh], length)
                out["pos"] = np.arange(len(front)) - np.repeat(np.cumsum(length) - length, length)
                waiting.append(out)
                held += len(out)
                if held >= BATCH_POSTINGS:
                    yield flush()
                    waiting, held = [], 0
        if waiting:
            yield flush()

    return run


def _lists(levels, usual: float):
    """Postings of the shingles that more than one node has, or whose lists are split: each list in the order of positions, in
    blocks of LIST_BLOCK postings at most, with a block's least position and range of sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [np.frombuffer(b.as_py(), POSTING) for batch in batches for b in batch.column(1)]
        if not blobs:
            return
        every = np.concatenate(blobs)
        every = every[np.lexsort((every["node"], every["token"]))]
        same = every["token"][1:] == every["token"][:-1]
        every = every[np.concatenate([[True], ~(same & (every["node"][1:] == every["node"][:-1]))])]
        same = every["token"][1:] == every["token"][:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        every = every[shared | (splits(levels.value[cells(every["token"])], usual) > 1)]
        if not len(every):
            return
        every = every[np.lexsort((every["node"], every["pos"], every["token"]))]
        begins = np.concatenate([[True], every["token"][1:] != every["token"][:-1]])
        place = np.arange(len(every)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        starts = np.flatnonzero(place % LIST_BLOCK == 0)
        lo, hi = np.minimum.reduceat(every["size"], starts), np.maximum.reduceat(every["size"], starts)
        ends = np.append(starts, len(every))
        for at in range(0, len(starts), 1024):
            to = min(at + 1024, len(starts))
            part, offsets = every[ends[at] : ends[to]], pa.array((ends[at : to + 1] - ends[at]).astype(np.int32))
            heads = part[ends[at:to] - ends[at]]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(part[c].astype(t))) for c, t in (("node", np.int64), ("size", np.int32), ("pos", np.int32))]
            columns = [heads["token"].astype(np.uint64).view(np.int64), heads["pos"].astype(np.int64), lo[at:to].astype(np.int64), hi[at:to].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *lists], names=["token", "least", "lo", "hi", "nodes", "sizes", "places"])

    return run


LISTS = "token long, least long, lo long, hi long, nodes array<long>, sizes array<int>, places array<int>"


def postings(lists: DataFrame, *kept: str) -> DataFrame:
    """token, node, size, pos, and the columns kept, of every posting."""
    each = lists.select("token", *kept, F.explode(F.arrays_zip("nodes", "sizes", "places")).alias("_p"))
    return each.select("token", *kept, F.col("_p.nodes").alias("node"), F.col("_p.sizes").cast("long").alias("size"), F.col("_p.places").cast("long").alias("pos"))


def parity(doc: np.ndarray, shingles: np.ndarray, n: int) -> list[bytes]:
    """For each of n documents, the parities of its shingles in BITS cells or, for large sets, in a power of two of
    twice their size or more. Cells go by the lowest bits, so a longer bitmap folds into a shorter one by xor."""
    size = np.bincount(doc, minlength=n)
    wide = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    first, last = np.cumsum(size) - size, np.cumsum(size)
    out, at = [], 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(np.cumsum(wide[at:]), 1 << 21, "right")) + at)
        begin = np.cumsum(wide[at:end]) - wide[at:end]
        lo, hi = first[at], last[end - 1]
        cell = (shingles[lo:hi] & (wide[doc[lo:hi]] - 1).astype(np.uint64)).astype(np.int64) + begin[doc[lo:hi] - at]
        odd = np.packbits((np.bincount(cell, minlength=int(wide[at:end].sum())) & 1).astype(np.uint8))
        out += [odd[b // 8 : (b + w) // 8].tobytes() for b, w in zip(begin.tolist(), wide[at:end].tolist(), strict=True)]
        at = end
    return out


def folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of size bytes."""
    if any(len(b) != size for b in bitmaps):
        bitmaps = [b if len(b) == size else np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, size // 8)).tobytes() for b in bitmaps]
    return np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), size // 8)


def _sets(k: int):
    """text -> node, size, parity bitmap and sorted shingles; each set once in a task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, data, offsets in textvec.groups(batch.column(0)):
                doc, hs = textvec.shingle_sets(data, offsets, k)
                n = len(offsets) - 1
                size, node = set_ids(doc, hs, n)
                end = np.cumsum(size)
                fresh = []
                for i, x in enumerate(node.tolist()):
                    if size[i] and x not in seen:
                        seen.add(x)
                        fresh.append(i)
                bits = parity(doc, hs, n)
                if fresh:
                    yield pa.RecordBatch.from_pydict({
                        "node": pa.array(node[fresh]), "size": pa.array(size[fresh]), "bits": pa.array([bits[i] for i in fresh], pa.binary()),
                        "shingles": pa.array([hs[end[i] - size[i] : end[i]].tobytes() for i in fresh], pa.binary()),
                    })

    return run


# --- pairs --------------------------------------------------------------------------------------------------------


def hubs_and_blocks(lists: DataFrame, percent: int) -> DataFrame:
    """Every list's hubs (x, its size m, place q and rank r), its HUBS nodes of smallest hash, with the list's blocks in which a pair can have room: blocks
    whose least position leaves too few shingles, or whose sizes are all too far from the hub's, are skipped unread."""
    ranked = postings(lists).withColumn("r", F.xxhash64("node", F.lit(23)))
    hubs = ranked.withColumn("n", F.row_number().over(Window.partitionBy("token").orderBy("r", "node"))).where(F.col("n") <= HUBS)
    hubs = hubs.select("token", F.col("node").alias("x"), F.col("size").alias("m"), F.col("pos").alias("q"), "r")
    near_size = (100 * F.col("hi") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.col("lo"))
    room = (100 + percent) * F.least(F.col("hi") - F.col("least"), F.col("m") - F.col("q")) >= percent * (F.col("lo") + F.col("m"))
    return lists.join(hubs, "token").where(near_size & room)


def stars(lists: DataFrame, percent: int) -> DataFrame:
    """x, y: pairs of every list's hubs with its nodes, but those whose sizes, or the places of the common shingle, leave no
    room for enough common shingles. Blocks are skipped before their postings are looked at."""
    met = postings(hubs_and_blocks(lists, percent), "x", "m", "q", "r").withColumn("rank", F.xxhash64("node", F.lit(23)))
    after = (F.col("rank") > F.col("r")) | ((F.col("rank") == F.col("r")) & (F.col("node") > F.col("x")))
    sizes = 100 * F.least("size", "m") >= percent * F.greatest("size", "m")
    room = (100 + percent) * F.least(F.col("size") - F.col("pos"), F.col("m") - F.col("q")) >= percent * (F.col("size") + F.col("m"))
    return met.where(after & sizes & room).select("x", F.col("node").alias("y")).distinct()


def open_cells(rows: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """token, node, size, comp of open lists -> cell, node, size, comp, once each: two nodes of a list that may be similar share
    a cell. Cells are named by a node. A list falls into bands of set size so wide that similar sets lie in one or in
    neighbours; a cell is the nodes of a band and of the next one over all lists in which the band's first node by hash is the same."""
    width = max(math.log(100 / percent), 1e-3) * 1.001  # wider than the ratio of similar sizes, rounding included
    band = F.floor(F.log(F.col("size")) / F.lit(width))
    dealt = rows.withColumn("band", band).withColumn("at", F.explode(F.array("band", F.col("band") - 1)))
    first = F.min_by("node", F.when(F.col("band") == F.col("at"), F.xxhash64("node", F.lit(23))))
    named = dealt.groupBy("token", "at").agg(first.alias("cell"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    named = cut(named.where("lo <> hi and cell is not null").select("token", "at", "cell"), made)
    return cut(dealt.join(near(named), ["token", "at"]).select("cell", "node", "size", "comp").distinct(), made)


def block_pairs(cells: DataFrame, width: float, made: list[DataFrame]) -> DataFrame:
    """cell, i, j, first, node, comp: each cell in blocks of about BLOCK nodes and BLOCK_BYTES, at width bytes for each shingle, and each
    of its nodes in every pair i <= j of blocks with its own; first tells whether its own is i."""
    many = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(width * F.sum("size") / BLOCK_BYTES))
    blocks = cut(cells.groupBy("cell").agg(many.alias("blocks")), made)
    placed = cells.join(near(blocks), "cell").withColumn("own", F.pmod(F.xxhash64("node", F.lit(29)), F.col("blocks")))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    return cut(paired.select("cell", i.alias("i"), j.alias("j"), (F.col("own") == i).alias("first"), "node", "size", "comp"), made)


class Overlaps:
    """Numbers of common elements of a set with each of columns, sets by an inverted index.

    A set's answers are derived from those of a similar set computed before (a hub): the lists of the elements that it has more
    are added and those that it lacks are subtracted. A set without a hub close enough is counted by all its elements, and
    becomes one."""

    def __init__(self, columns: list[np.ndarray], hubs: int = 8):
        self.n, self.hubs, self.most = len(columns), [], hubs
        every = np.concatenate(columns)
        owner = np.repeat(np.arange(self.n), [len(c) for c in columns])
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.elements, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))

    def _counted(self, elements: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.elements, elements), len(self.elements) - 1)
        at = at[self.elements[at] == elements]
        size = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.owner[places], minlength=self.n)

    def of(self, s: np.ndarray) -> np.ndarray:
        best, far = None, len(s)
        for hub, answers in self.hubs:
            at = np.minimum(np.searchsorted(hub, s), len(hub) - 1)
            common = hub[at] == s
            apart = len(s) + len(hub) - 2 * int(common.sum())
            if apart < far:
                best, far = (hub, answers, at, common), apart
        if best is None:
            answers = self._counted(s)
            self.hubs = [(s, answers), *self.hubs[: self.most - 1]]
            return answers
        hub, answers, at, common = best
        lacks = np.ones(len(hub), bool)
        lacks[at[common]] = False
        return answers + self._counted(s[~common]) - self._counted(hub[lacks])


def spanning_links(sets: list[np.ndarray], comp: np.ndarray, rows: np.ndarray, columns: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between rows and columns (places in sets) that join components: one for each join, so fewer than sets."""
    size, (_, label) = np.array([len(s) for s in sets], np.int64), np.unique(comp, return_inverse=True)
    overlaps, out = Overlaps([sets[c] for c in columns]), []
    for a in rows.tolist():
        # Columns in the set's own component need no answer, nor do those of a size that excludes them.
        if not ((label[columns] != label[a]) & (100 * np.minimum(size[columns], size[a]) >= percent * np.maximum(size[columns], size[a]))).any():
            continue
        alike = (overlaps.of(sets[a]) >= need(size[a], size[columns], percent)) & (label[columns] != label[a])
        if alike.any():
            others, at = np.unique(label[columns[alike]], return_index=True)
            out += [(a, int(c)) for c in columns[alike][at]]
            label[np.isin(label, others)] = label[a]
    return out


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two blocks of a pair; those of one block twice, if it meets itself."""
    first, places = np.asarray(group.column("first")).astype(bool), np.arange(group.num_rows)
    return (places, places) if group.column("i")[0] == group.column("j")[0] else (places[first], places[~first])


def _alive(percent: int):
    """The nodes of a block pair that have a candidate in another component: sizes and parity bitmaps don't exclude it."""

    def run(group: pa.Table) -> pa.Table:
        node, size, comp = (np.asarray(group.column(c)) for c in ("node", "size", "comp"))
        maps = group.column("bits").to_pylist()
        bits = folded(maps, min(map(len, maps)))
        alive = np.zeros(len(node), bool)
        rows, columns = _sides(group)
        theirs = bits[columns]
        for a in rows.tolist():
            other = (comp[columns] != comp[a]) & (100 * np.minimum(size[columns], size[a]) >= percent * np.maximum(size[columns], size[a]))
            if other.any():
                at = columns[other]
                near_ = np.bitwise_count(theirs[other] ^ bits[a]).sum(axis=1, dtype=np.int64) <= distance_limit(size[a], size[at], percent)
                alive[at[near_]] = True
                alive[a] |= near_.any()
        return pa.table({"cell": group.column("cell"), "node": group.column("node"), "size": group.column("size"), "comp": group.column("comp")}).filter(pa.array(alive))

    return run


def _cell_links(percent: int):
    def run(group: pa.Table) -> pa.Table:
        node, comp = (np.asarray(group.column(c)) for c in ("node", "comp"))
        sets = [np.frombuffer(b.as_py(), np.uint64) for b in group.column("shingles")]
        rows, columns = _sides(group)
        order = np.lexsort((node[rows], [len(sets[r]) for r in rows]))
        pairs = spanning_links(sets, comp, rows[order], columns, percent) if len(rows) and len(columns) else []
        at = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.table({"x": pa.array(node[at[:, 0]], pa.int64()), "y": pa.array(node[at[:, 1]], pa.int64())})

    return run


def distance_limit(a, b, percent: int):
    """Largest symmetric difference of similar sets of these sizes."""
    return a + b - 2 * need(a, b, percent)


def _meet(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """x, y, sizes and the column of both; the sets are read where they lie if the pairs are few enough to broadcast."""
    right = sets.select(F.col("node").alias("y"), F.col("size").alias("m"), F.col(column).alias("b")).join(near(pairs), "y")
    left = sets.select(F.col("node").alias("x"), F.col("size").alias("n"), F.col(column).alias("a")).join(near(pairs.select("x").distinct()), "x")
    return right.join(left, "x").select("x", "y", "n", "m", "a", "b")


def _kept(test):
    def run(batches):
        for batch in batches:
            n, m = (np.asarray(batch.column(i)) for i in (2, 3))
            ok = test(n, m, batch.column(4).to_pylist(), batch.column(5).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["x", "y"])

    return run


def possible(pairs: DataFrame, sets: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """The pairs (x, y) that parity bitmaps don't exclude."""

    def test(n, m, a, b):
        far, size = np.zeros(len(n), np.int64), np.array([min(len(p), len(q)) for p, q in zip(a, b, strict=True)], np.int64)
        for w in np.unique(size):
            at = np.flatnonzero(size == w)
            far[at] = np.bitwise_count(folded([a[i] for i in at], int(w)) ^ folded([b[i] for i in at], int(w))).sum(axis=1, dtype=np.int64)
        return far <= distance_limit(n, m, percent)

    return cut(_meet(pairs, sets, "bits").mapInArrow(lean(_kept(test)), "x long, y long").distinct(), made)


def similar(pairs: DataFrame, sets: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar."""

    def test(n, m, a, b):
        common = [len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True)) for p, q in zip(a, b, strict=True)]
        common = np.array(common, np.int64)
        return 100 * common >= percent * (n + m - common)

    return cut(_meet(pairs, sets, "shingles").mapInArrow(lean(_kept(test)), "x long, y long").distinct(), made)


def _labelled(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))


def proved(pairs: DataFrame, sets: DataFrame, percent: int, made: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(links, components) after verifying pairs. Of every node, one pair comes first; what the components of these prove is
    not verified again."""
    maybe = possible(pairs, sets, percent, made)
    first = cut(maybe.groupBy("y").agg(F.min(F.struct(F.xxhash64("x"), "x")).alias("hub")).select("hub.x", "y"), made)
    links = similar(first, sets, percent, made)
    labels = _labelled(links)
    a, b = (labels.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in "xy")
    apart = F.coalesce("cx", "x") != F.coalesce("cy", "y")
    rest = cut(maybe.join(near(first), ["x", "y"], "left_anti").join(near(a), "x", "left").join(near(b), "y", "left").where(apart).select("x", "y"), made)
    if not rest.isEmpty():
        made.append(labels)
        links = links.union(similar(rest, sets, percent, made))
        labels = _labelled(links)
    return links, labels


# --- the join -----------------------------------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, k: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id of every row; sets link at Jaccard similarity of percent / 100 or more."""
    heads, labels = _linked(docs, k, percent, key, text)
    # Documents: a class of equal sets is one row until the end.
    classes = heads.where("n > 0").groupBy("node").agg(F.min("id").alias("least")).join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ends = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = classes.join(ends, "comp").select("node", "component_id")
    # Empty sets have no class: their rows don't meet in the task of one node.
    joined = heads.withColumn("node", F.when(F.col("n") > 0, F.col("node")).otherwise(F.xxhash64("id"))).join(named, "node", "left")
    return joined.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"))


def classes(docs: DataFrame, k: int, percent: int, kept: list[Column], key: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """id, the columns kept, words (their number) and class (of equal or linked sets) of every row, and the tables to drop when
    that is written."""
    heads, labels = _linked(docs, k, percent, key, text, kept)
    found = heads.join(near(labels), "node", "left").withColumn("class", F.coalesce("comp", "node"))
    return found.drop("node", "comp", "n"), [heads, labels]


def _linked(docs: DataFrame, k: int, percent: int, key: str, text: str, kept: list[Column] = []) -> tuple[DataFrame, DataFrame]:
    """(id, columns kept, words, n, node of every row; node, comp of every node with a link), both in the shared folder, where nothing else stays."""
    spark, made = docs.sparkSession, []
    whole = docs.select(F.col(key).alias("id"), *kept, F.col(text).cast("string").alias("t"))
    texts = whole.select("id", "t")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema[:-1])
    with small_batches(spark), dropping(made):
        first = cut(whole.mapInArrow(lean(_heads(k)), f"{own}, words long, n long, node long, chunk int, sketch binary"), made)
        heads = cut(first.where("chunk is null").drop("chunk", "sketch"))
        total = heads.agg(F.sum("n")).first()[0] or 0
        usual = max(total / CELLS, 1.0)
        # 1. The global order.
        sketches = gathered(first.where("chunk is not null").select("chunk", "sketch"), shuffle_width(spark))
        merged = sketches.repartition(min(CHUNKS, shuffle_width(spark)), "chunk").mapInArrow(lean(_merged(usual)), "chunk int, level binary").collect()
        levels = np.zeros(CELLS, np.uint8)
        for r in merged:
            levels.reshape(CHUNKS, -1)[r.chunk] = np.frombuffer(zlib.decompress(r.level), np.uint8)
        shared = spark.sparkContext.broadcast(levels)
        # 2. The index, without the lists of one node.
        parts = max(shuffle_width(spark), int(total * (105 - percent) / 100) // PART_POSTINGS + 1)
        packed = texts.select("t").mapInArrow(lean(_postings(k, percent, shared, usual, parts)), "part int, blob binary")
        lists = cut(packed.repartition(parts, "part").mapInArrow(lean(_lists(shared, usual)), LISTS), made)
        # 3. The sets of the nodes in it, each read from one of its documents.
        nodes = lists.select(F.explode("nodes").alias("node")).distinct()
        ids = cut(heads.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("want")).select("want").distinct(), made)
        sets = cut(texts.join(near(ids), F.col("id").eqNullSafe(F.col("want")), "left_semi").select("t").mapInArrow(lean(_sets(k)), "node long, size long, bits binary, shingles binary"), made)
        # 4. Stars, and what they prove.
        links, labels = proved(cut(stars(lists, percent), made), sets, percent, made)
        # 5. Lists that are still open.
        known = postings(lists).join(labels, "node", "left").select("token", "node", "size", F.coalesce("comp", "node").alias("comp"))
        open_ = cut(known.groupBy("token").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where((F.col("n") > HUBS + 1) & (F.col("lo") != F.col("hi"))).select("token"), made)
        if not open_.isEmpty():
            paired = block_pairs(open_cells(known.join(near(open_), "token", "left_semi"), percent, made), 0.5, made)
            met = sets.select("node", "bits").join(near(paired), "node").groupBy("cell", "i", "j")
            alive = cut(met.applyInArrow(_alive(percent), "cell long, node long, size long, comp long").distinct(), made)
            paired = block_pairs(alive, 8, made)
            met = sets.select("node", "shingles").join(near(paired), "node").groupBy("cell", "i", "j")
            found = cut(met.applyInArrow(_cell_links(percent), "x long, y long").distinct(), made)
            if not found.isEmpty():
                made.append(labels)
                labels = _labelled(links.union(found))
        shared.destroy()
    return heads, labels


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(a[i:i + least(len(a), 4) - 1], ' ')) AS g
  FROM (SELECT doc_id, a, unnest(range(1, len(a) - least(len(a), 4) + 2)) AS i FROM w WHERE len(a) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.least, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id) m USING (doc_id)
"""
