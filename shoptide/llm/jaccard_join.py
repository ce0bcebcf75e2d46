"""Similarity join on word n-grams with signature trees.

Documents meet in blocks: by the prefix principle two documents whose Jaccard similarity reaches the threshold share
a shingle among the first few of either in any order that holds for all documents. Inside a block a tree is built whose
nodes hold OR-combined bitmaps and size ranges; pairs of nodes are walked down together and left as soon as the largest
possible overlap below them is too small, or everything below them is already known to be connected. What reaches the
leaves is compared exactly, by whole sets and within the task that holds them: pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import components, whole_runs, without, written
from shoptide.llm.exact_dedup import located
from shoptide.operators.keyed import near_keys

WORDS = 4
PERCENT = 85
# Shingles in more prefixes than this come last in the common order, so that few prefixes hold them.
FREQUENT, SHARE = 16, 4
# Frequent shingles are marked in a bitmap of fixed size, 4 MB. A rare one that shares a bit comes late too, which is harmless.
BITMAP_BITS = 1 << 25
# A document's signature has four to eight bits per shingle, a power of two between these. So few of them are set that
# what two documents differ in shows almost in full.
LEAST_BITS, MOST_BITS = 256, 1 << 16
LEAF, FAN_OUT = 8, 8
# Larger blocks are cut into tiles of this many documents and every pair of tiles is a task's work.
TILE = 1024
# Smallest shingles of a set by which the first round brings documents together.
LOWEST = 2
BATCH_BYTES = 1 << 20
# Bitmaps that pairs of nodes are compared by at once.
PAIR_BYTES = 1 << 25

_U = np.uint64
_BYTES = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]  # A-Z are read as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = [_U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 20), base, np.uint64)
        table[0] = 1
        table = _powers[base] = np.multiply.accumulate(table)
    return table[:n]


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text. ``data``: the UTF-8 bytes of all texts; ``ends``: where
    each begins, and the end of the last."""
    n = len(ends) - 1
    inside = ~_SPACE[data]
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    cuts = ends[:-1][ends[:-1] < len(data)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _power_table(_BASE, len(data)), dtype=np.uint64)))
    word = _mix((sums[stops] - sums[starts]) * _power_table(_INVERSE, len(data) + 1)[starts] + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, ends)
    count = np.diff(first)
    grams = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for k in range(words):
        grams = _mix(grams + _STEP[k % 4] * word[k : k + len(grams)])
    out = []
    for i in range(n):
        at, have = first[i], count[i]
        if have >= words:
            found = np.sort(grams[at : at + have - words + 1])
            out.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        elif have:
            short = np.array([have], np.uint64)
            for w in word[at : at + have]:
                short = _mix(short * _STEP[3] + w)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _text_sets(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """Shingle sets of an Arrow text column, some megabytes at a time."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + BATCH_BYTES, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        lo, hi = offsets[start], offsets[end]
        yield shingle_sets(data[lo:hi], offsets[start : end + 1] - lo, words)
        start = end


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _documents(rows: DataFrame, words: int, percent: int, frequent=None) -> DataFrame:
    """(_id, file, row, n, s1, s2, low, prefix) of rows (_id, _text, file, row): set size, two sums that stand for the set, its
    smallest shingles, its prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent) if frequent is not None else None

    def lists(parts: list[np.ndarray]) -> pa.Array:
        ends = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64), pa.int64()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value if shared is not None else None
        for batch in batches:
            sizes, one, two, low, prefixes = [], [], [], [], []
            for found in _text_sets(batch.column(1), words):
                for grams in found:
                    sizes.append(len(grams))
                    one.append(grams.sum(dtype=np.uint64))
                    two.append(_mix(grams ^ _STEP[2]).sum(dtype=np.uint64))
                    low.append(grams[:LOWEST])
                    need = prefix_length(len(grams), percent) if len(grams) else 0
                    if bitmap is not None and need:
                        often = is_frequent(bitmap, grams)
                        grams = np.concatenate((grams[~often][:need], grams[often][:need]))
                    prefixes.append(grams[:need])
            as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), as_long(one), as_long(two), lists(low), lists(prefixes)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "file", "row", "n", "s1", "s2", "low", "prefix"])

    return rows.select("_id", "_text", "file", "row").mapInArrow(
        sets, "_id bigint, file string, row bigint, n bigint, s1 bigint, s2 bigint, low array<bigint>, prefix array<bigint>")


def is_frequent(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    slot = grams & _U(BITMAP_BITS - 1)
    return (bitmap[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) > 0


def _share(rows: DataFrame, parts: int, *columns: str) -> DataFrame:
    """One in ``parts`` of the rows, by their hash. What is counted from it only says how work is dealt out."""
    return rows.filter(F.pmod(F.xxhash64(*columns), F.lit(parts)) == 0)


def _frequent(documents: DataFrame) -> np.ndarray | None:
    """Bitmap of the shingles in more than about FREQUENT prefixes, counted in one document of four; at most
    BITMAP_BITS / 64 words reach the driver. Any bitmap makes an order that holds for all documents."""
    some = _share(documents, SHARE, "file", "row")
    often = some.select(F.explode("prefix").alias("h")).groupBy("h").count().filter(F.col("count") > FREQUENT // SHARE)
    slot = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 AS int))")
    words = often.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    if not words:
        return None
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    bitmap[[w.word for w in words]] = [w.bits for w in words]
    return bitmap.view(np.uint64)


# Blocks over this many documents are taken apart in Spark and not looked through for rows that cannot meet. One document of so
# many shows which they are.
HOT, HOT_SHARE = 1 << 16, 64


def meeting(n: np.ndarray, pos: np.ndarray, comp: np.ndarray, percent: int) -> np.ndarray:
    """Numbers of the members of a block that may be similar to one of another component, ordered by size.

    Two sets whose first common shingle stands at place ``pos`` of one of them share at most what follows there, which limits
    the size of the other; and a size must be in reach of the other.
    """
    at = np.lexsort((pos, n))
    while len(at):
        size, group = n[at], comp[at]
        most = np.minimum(100 * size // percent, (size - pos[at]) * (100 + percent) // percent - size)
        lo, hi = np.searchsorted(size, -(-percent * size // 100)), np.searchsorted(size, most, side="right")
        # Where the next member of another component than a member's stands.
        change = np.flatnonzero(np.diff(group)) + 1
        following = np.append(change, len(at))[np.searchsorted(change, np.arange(len(at)), side="right")]
        first = np.minimum(lo, len(at) - 1)
        keep = (lo < hi) & ((group[first] != group) | (following[first] < hi))
        if keep.all():
            break
        at = at[keep]
    return at


def _blocks(postings: DataFrame, percent: int) -> DataFrame:
    """(block, rep, n, comp, members): of the documents that share a shingle of ``postings`` (h, rep, n, comp, pos), those that
    may be similar to one of another component. Shingles shared by the same documents make one block.

    Rows are sorted within tasks and read as a stream. Shingles of more than ``HOT`` documents are counted before and never
    gathered: their documents go on as they are, to be dealt out in tiles.
    """
    # One document of 64 shows which shingles may be in so many; of those all are counted.
    seen = _share(postings, HOT_SHARE, "rep").groupBy("h").agg(F.count("*").alias("seen")).filter(F.col("seen") > HOT // (2 * HOT_SHARE))
    seen = written(seen.select("h"), "hot-shingles")
    some = not seen.isEmpty()
    hot = near_keys(postings, seen, ["h"]).groupBy("h").agg(F.count("*").alias("members")).filter(F.col("members") > HOT)
    hot = written(hot, "hot-shingles") if some else seen
    some = some and not hot.isEmpty()
    few = without(postings, hot, ["h"]) if some else postings
    sorted_rows = few.repartition("h").sortWithinPartitions("h", "rep")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, found in whole_runs(batches, 1):
            _, rep, n, comp, pos = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            starts = np.array([start for start, _ in found])
            several = np.flatnonzero(np.minimum.reduceat(comp, starts) < np.maximum.reduceat(comp, starts)).tolist()
            picks, marks, sizes = [], [], []
            for k in several:
                start, end = found[k]
                pick = start + meeting(n[start:end], pos[start:end], comp[start:end], percent)
                mark = int(_mix(rep[pick].astype(np.uint64) + _STEP[1]).sum(dtype=np.uint64))
                if len(pick) and mark not in seen:
                    if len(seen) < 1 << 20:
                        seen.add(mark)
                    picks.append(pick)
                    marks.append(mark)
                    sizes.append(len(pick))
            if picks:
                pick = np.concatenate(picks)
                block = np.repeat(np.array(marks, np.uint64).view(np.int64), sizes)
                columns = [block, rep[pick], n[pick], comp[pick], np.repeat(sizes, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["block", "rep", "n", "comp", "members"])

    schema = "block bigint, rep bigint, n bigint, comp bigint, members bigint"
    out = sorted_rows.select("h", "rep", "n", "comp", "pos").mapInArrow(runs, schema).dropDuplicates(["block", "rep"])
    if some:
        rows = near_keys(postings, hot, ["h"]).join(hot, "h")
        spread = rows.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("h")
        out = out.unionByName(rows.join(spread, "h").select(F.col("h").alias("block"), "rep", "n", "comp", "members"))
    return out


def _tiled(blocks: DataFrame) -> DataFrame:
    """Blocks over TILE documents become pairs of tiles: each document goes to the pairs that hold its tile."""
    tiles = F.ceil(F.col("members") / TILE)
    own = F.pmod(F.xxhash64("rep"), tiles)
    pairs = F.when(tiles == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), lambda other: F.least(own, other) * tiles + F.greatest(own, other)))
    return blocks.withColumn("pair", F.explode(pairs))


def _members(blocks: DataFrame, rows: DataFrame, reps: DataFrame, words: int, signatures: bool = False) -> DataFrame:
    """``blocks`` (block, pair, rep, n, comp) with the documents' sets (grams) from their texts, or their bitmaps (sig).

    Texts of documents that are in a block meet the list of their blocks by one join; sets, which are wider than texts, are only
    shuffled to where they are compared.
    """
    name = "sig" if signatures else "grams"
    member = F.struct("block", "pair", "n", "comp")
    wanted = blocks.join(reps.select("rep", "file", "row"), "rep").groupBy("file", "row").agg(F.first("rep").alias("rep"), F.collect_list(member).alias("at"))
    near = near_keys(rows, wanted, ["file", "row"]).select("file", "row", "_text").join(wanted, ["file", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for found in _text_sets(batch.column(0), words):
                if signatures:
                    values = pa.array([signature(g).tobytes() for g in found], pa.binary())
                else:
                    ends = pa.array(np.concatenate(([0], np.cumsum([len(g) for g in found]))), pa.int32())
                    values = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found).view(np.int64), pa.int64()))
                part = batch.slice(start, len(found))
                start += len(found)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), values], ["rep", "at", name])

    kinds = "array<struct<block: bigint, pair: bigint, n: bigint, comp: bigint>>"
    sets = near.select("_text", "rep", "at").mapInArrow(run, f"rep bigint, at {kinds}, {name} {'binary' if signatures else 'array<bigint>'}")
    return sets.select("rep", F.explode("at").alias("at"), name).select("at.*", "rep", name)


class Tree:
    """Signature tree over documents sorted by size: level 0 holds the documents' bitmaps, every node above the
    OR of its children, the range of their sizes and the smallest number of bits of any document below."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray):
        bits = np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, bits)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, few = self.levels[-1]
            at = np.arange(0, len(maps), width)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(few, at)))
            width = FAN_OUT

    def pairs(self, percent: int, group: np.ndarray | None = None) -> np.ndarray:
        """(k, 2) numbers of documents that may be similar enough, from a walk of the tree against itself. Pairs
        of equal ``group`` are left out."""
        top = len(self.levels) - 1
        left = right = np.zeros(1, np.int64)
        if group is not None:
            lows, highs = [group], [group]
            width = LEAF
            for level in self.levels[1:]:
                at = np.arange(0, len(lows[-1]), width)
                lows.append(np.minimum.reduceat(lows[-1], at))
                highs.append(np.maximum.reduceat(highs[-1], at))
                width = FAN_OUT
        for depth in range(top, -1, -1):
            keep = self._possible(depth, left, right, percent)
            if group is not None:
                lo, hi = lows[depth], highs[depth]
                keep &= ~((lo[left] == hi[left]) & (lo[right] == hi[right]) & (lo[left] == lo[right]))
            left, right = left[keep], right[keep]
            if depth == 0:
                break
            width = LEAF if depth == 1 else FAN_OUT
            below = len(self.levels[depth - 1][0])
            step = np.arange(width)
            a = (left[:, None, None] * width + step[None, :, None]).repeat(width, axis=2).ravel()
            b = (right[:, None, None] * width + step[None, None, :]).repeat(width, axis=1).ravel()
            keep = (a < below) & (b < below) & ((a < b) if depth == 1 else (a <= b))
            left, right = a[keep], b[keep]
        both = left != right
        return np.stack((left[both], right[both]), axis=1)

    def _possible(self, depth: int, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
        """Whether documents below two nodes can reach the threshold: of a document's bits, those that the other
        node lacks stand for at least as many shingles that are not shared."""
        maps, low, high, few = self.levels[depth]
        # The larger set must not outgrow the smaller one.
        out = (100 * high[left] >= percent * low[right]) & (100 * high[right] >= percent * low[left])
        at = np.flatnonzero(out)
        step = max(1, PAIR_BYTES // maps[0].nbytes)
        for start in range(0, len(at), step):
            part = at[start : start + step]
            l, r = left[part], right[part]
            common = np.bitwise_count(maps[l] & maps[r]).sum(axis=1).astype(np.int64)
            overlap = np.minimum(high[l] - np.maximum(few[l] - common, 0), high[r] - np.maximum(few[r] - common, 0))
            # Jaccard >= percent / 100 means overlap * (100 + percent) >= percent * (size + size).
            out[part] = overlap * (100 + percent) >= percent * (low[l] + low[r])
        return out


def signature_bits(size: int) -> int:
    return min(max(4 << max(size - 1, 0).bit_length(), LEAST_BITS), MOST_BITS)


def signature(grams: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Bitmap of a set of hashes. The halves of a bitmap, ORed, are the bitmap of half as many bits."""
    bits = bits or signature_bits(len(grams))
    taken = np.zeros(bits, bool)
    taken[(grams.view(np.uint64) >> _U(40)).astype(np.int64) & (bits - 1)] = True
    return np.packbits(taken).view(np.uint64)


def possible_pairs(maps: list[np.ndarray], n: np.ndarray, group: np.ndarray, percent: int) -> np.ndarray:
    """(k, 2) numbers of documents that may be similar, of unequal ``group``. There is a tree for each width of bitmap,
    which also takes the folded bitmaps of the next width that are in reach by size; no pair spans more."""
    width = np.array([len(m) for m in maps])
    found = [np.zeros((0, 2), np.int64)]
    for w in np.unique(width).tolist():
        at = np.flatnonzero((width == w) | ((width == 2 * w) & (n * percent <= 100 * n[width == w].max())))
        at = at[np.argsort(n[at], kind="stable")]
        folded = np.stack([maps[i] if width[i] == w else maps[i][:w] | maps[i][w:] for i in at])
        found.append(at[Tree(folded, n[at]).pairs(percent, group[at])])
    return np.concatenate(found)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def block_links(ids: np.ndarray, sets: list[np.ndarray], percent: int, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the documents of a block as all its similar pairs would: pairs are compared exactly in the
    order of the tree walk, and those already connected, at first by ``group``, are passed over."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    ids, sets, sizes = ids[order], [sets[i] for i in order], sizes[order]
    root = np.arange(len(ids)) if group is None else np.unique(group[order], return_inverse=True)[1]
    bits = signature_bits(int(sizes[-1]))
    pairs = Tree(np.stack([signature(s, bits) for s in sets]), sizes).pairs(percent, root.copy())
    links = []
    # Pairs that have been connected meanwhile are left out now and then, all at once.
    for start in range(0, len(pairs), 1 << 12):
        part = pairs[start : start + (1 << 12)]
        for a, b in part[root[part[:, 0]] != root[part[:, 1]]].tolist():
            if root[a] != root[b] and similar(sets[a], sets[b], percent):
                links.append((int(ids[a]), int(ids[b])))
                root[root == root[b]] = root[a]
    return links


def _by_block(members: DataFrame, names: list[str], function) -> DataFrame:
    """(a, b): what ``function`` of (a batch, the start and end of a block's rows) finds, block after block."""
    rows = members.repartition("block", "pair").sortWithinPartitions("block", "pair", "rep").select("block", "pair", "rep", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in whole_runs(batches, 2):
            links = [link for start, end in found if end - start > 1 for link in function(batch, start, end)]
            a, b = zip(*dict.fromkeys(links), strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _linked(blocks: DataFrame, rows: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): exact links inside blocks (block, pair, rep, n, comp), one tree and comparison of whole sets per block."""

    def links(batch: pa.RecordBatch, start: int, end: int):
        ids, comp = (batch.column(i).slice(start, end - start).to_numpy() for i in (2, 3))
        column = batch.column(4).slice(start, end - start)
        return block_links(ids, [column[i].values.to_numpy() for i in range(len(column))], percent, comp)

    return _by_block(_members(blocks, rows, reps, words), ["comp", "grams"], links)


def _candidates(blocks: DataFrame, rows: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that connect the documents of each block (block, pair, rep, n, comp) as all pairs of different components
    would that the bitmaps leave possible, from one tree per block. A document has one of them per block at most."""

    def forest(batch: pa.RecordBatch, start: int, end: int):
        ids, n, comp = (batch.column(i).slice(start, end - start).to_numpy() for i in (2, 3, 4))
        maps = [np.frombuffer(m, np.uint64) for m in batch.column(5).slice(start, end - start).to_pylist()]
        found = possible_pairs(maps, n, comp, percent)
        root = np.arange(len(ids))
        while True:
            a, b = root[found[:, 0]], root[found[:, 1]]
            apart = a != b
            if not apart.any():
                break
            found = found[apart]
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while not (root[root] == root).all():
                root = root[root]
        at = np.flatnonzero(root != np.arange(len(ids)))
        return zip(ids[root[at]].tolist(), ids[at].tolist(), strict=True)

    return _by_block(_members(blocks, rows, reps, words, signatures=True), ["n", "comp", "sig"], forest)


def _counted(blocks: DataFrame) -> DataFrame:
    """Blocks (block, rep, ...) of two or more documents, with ``members``."""
    sizes = blocks.groupBy("block").agg(F.count("*").alias("members")).filter("members > 1")
    return blocks.join(sizes, "block")


def _with_component(reps: DataFrame, comps: DataFrame) -> DataFrame:
    return reps.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: (id, n_shingles, component_id, survivor, file, row).

    A-Z are read as a-z and words are runs of anything but ASCII white space. A document's set holds its distinct
    shingles of ``words`` words; with fewer words the whole sequence is its one shingle; null and empty texts and
    those without words have an empty set and no link. Two documents are linked when 100 * |A and B| >= percent *
    |A or B|; the component is the smallest id that links lead to, the own one included. Every row is a document of
    its own: rows with a null id take part with their text and only name a component of nothing else, which then is null;
    rows that repeat an id with other texts may belong to different components. ``survivor`` holds for one row of every
    component and for every row with an empty set. Other columns are not read; an empty table gives an empty table.

    Ids are integers. Shingles are compared as 64-bit hashes. Documents with equal sets are one class,
    whatever its size, and only classes are joined; the links kept are enough to connect what all similar
    pairs connect, so a group of near copies gives no pair list.
    """
    rows = located(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col).withColumn("_text", F.coalesce(F.col("_text"), F.lit("")))
    everything = written(_documents(rows, words, percent), "shingles")
    key = ["n", "s1", "s2"]
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "file", "row")
    bitmap = _frequent(everything)
    documents = everything if bitmap is None else _documents(rows, words, percent, bitmap)
    full = documents.filter("n > 0").groupBy(*key).agg(F.min(place).alias("first"), F.first("low").alias("low"), F.first("prefix").alias("prefix"))
    # A class has a number of its own, fixed by writing it, and the place of one of its texts.
    reps = written(full.withColumn("rep", F.monotonically_increasing_id()).withColumns({"file": F.col("first.file"), "row": F.col("first.row")}), "shingle-classes")

    # First round: documents that share one of their smallest shingles, which near copies mostly do. It only saves work:
    # a large block is cut into tiles that are not compared with each other, but for one document of each component.
    blocks = _counted(reps.select("rep", "n", F.explode("low").alias("block"), F.col("rep").alias("comp")))
    tile = F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / TILE))
    blocks = written(blocks.withColumn("pair", tile), "blocks")
    links = written(_linked(blocks, rows, reps, words, percent), "links")
    comps = written(components(links, "components"), "components")
    large = _with_component(blocks.filter(F.col("members") > TILE).select("block", "rep", "n"), comps)
    large = large.groupBy("block", "comp").agg(F.min(F.struct("rep", "n")).alias("one"))
    large = _counted(large.select("block", "comp", "one.rep", "one.n"))
    large = written(large.withColumn("pair", tile), "blocks")
    if not large.isEmpty():
        links = written(links.unionByName(_linked(large, rows, reps, words, percent)), "links")
        comps = written(components(links, "components"), "components")

    # Second round: all of the prefixes. Documents that may be similar to one of another component are told by their
    # bitmaps; the groups they make are compared by whole sets, each document in one group.
    postings = _with_component(reps, comps).select("rep", "n", "comp", F.posexplode("prefix").alias("pos", "h"))
    blocks = written(_tiled(_blocks(postings, percent)).select("block", "pair", "rep", "n", "comp"), "blocks")
    near = written(components(written(_candidates(blocks, rows, reps, words, percent), "candidates"), "near"), "near")
    groups = _with_component(near.select(F.col("node").alias("rep"), F.col("component").alias("block")).join(reps.select("rep", "n"), "rep"), comps)
    groups = written(_tiled(_counted(groups)), "groups")
    comps = components(written(links.unionByName(_linked(groups, rows, reps, words, percent)), "links"), "components")

    named = _with_component(reps.select(*key, "rep", "first"), comps)
    names = named.groupBy("comp").agg(F.min("first").alias("name"))
    out = everything.select("_id", "file", "row", *key).join(named.join(names, "comp").select(*key, "name"), key, "left")
    empty = F.col("n") == 0
    own = (F.col("file") == F.col("name.file")) & (F.col("row") == F.col("name.row"))
    return out.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(empty, F.col("_id")).otherwise(F.col("name._id")).alias("component_id"),
        (empty | own).alias("survivor"), "file", "row")
