"""Exact top-k search by inner product without random access: sorted lists are read in sequence, lower and upper bounds
of scores decide when no further vector can qualify, and the scores of those that still can are resolved at the end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm.common import whole_runs, written

TOP = 5
SCALE = 256
# Every vector whose id is divisible by this is a query.
QUERY_STEP = 50
# Vectors of a block, which has sorted lists of its own; queries that travel together; blocks that a task goes through
# with the same queries, so that the scores of the first ones shorten the reading of the others.
BLOCK, QUERIES, CHAIN = 4096, 256, 8
# Depths at which the reading of a list may stop; steps that it goes on to tell vectors apart that were met, and the share
# of a block that may be left then.
STEPS, FURTHER, FEW = 64, 8, 8


class SortedLists:
    """A block of vectors with two lists per component, from the largest value down and from the smallest one up."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        up = np.argsort(x.T, axis=1, kind="stable")
        self.order = np.concatenate((up[:, ::-1], up))
        self.values = np.take_along_axis(np.concatenate((x.T, x.T)), self.order, axis=1).astype(np.float64)
        # Depths at which reading may stop.
        self.depths = np.unique(np.ceil(np.arange(1, STEPS + 1) * len(x) / STEPS).astype(np.int64))

    def candidates(self, query: np.ndarray, top: int, floor: float, slack: float = 0.0) -> np.ndarray:
        """Vectors that may be among the ``top`` best or reach ``floor``, a score that ``top`` vectors of other
        blocks reach: all others score less than ``top`` vectors that are known.

        Each list is read from the end that raises the score: downwards for a positive component of the query,
        upwards for a negative one, all to the same depth. A vector's lower bound takes the worst value of each list it
        was not met in, its upper bound the value last read there. Reading stops where a vector that was met in no list
        cannot qualify: its upper bound is the sum of the values last read.
        """
        size = len(self.x)
        used = np.flatnonzero(query)
        q = query[used].astype(np.float64)
        lists = np.where(q > 0, used, used + self.x.shape[1])
        frontier = self.values[lists][:, self.depths - 1] * q[:, None]
        outside = frontier.sum(axis=0)
        worst = frontier[:, -1]
        lower = np.full(size, worst.sum())
        bound, read = floor - slack, 0
        while True:
            # Straight to where outsiders cannot reach the bound; in larger and larger steps while none is known.
            known = np.flatnonzero(outside < bound)
            step = int(known[0]) if len(known) else len(self.depths) - 1
            if floor == -np.inf:
                step = min(step, int(np.searchsorted(self.depths, min(size, max(2 * read, 1)))))
            depth = int(self.depths[step])
            if floor == -np.inf and size >= top:
                lower += self._sums(lists, read, depth, q, worst)
                bound = max(bound, np.partition(lower, size - top)[size - top] - slack)
            read = depth
            if read == size or outside[step] < bound:
                break
        # Some steps further, until few are left of those that were met.
        while True:
            step = min(step + FURTHER, len(self.depths) - 1)
            read = int(self.depths[step])
            upper = outside[step] + self._sums(lists, 0, read, q, frontier[:, step])
            found = np.flatnonzero(upper >= bound)
            if read == size or len(found) <= max(top, size // FEW):
                return found

    def _sums(self, lists: np.ndarray, start: int, end: int, q: np.ndarray, less: np.ndarray) -> np.ndarray:
        """By vector, what the entries ``start`` to ``end`` of the lists add to a sum of ``less`` over all lists."""
        found = self.order[lists, start:end]
        return np.bincount(found.ravel(), (self.values[lists, start:end] * q[:, None] - less[:, None]).ravel(), len(self.x))


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:top]


def _blocked(rows: DataFrame, count: int, names: list[str], name: str) -> DataFrame:
    """``names`` (block, ids, places, x): rows dealt out by place to ``count`` blocks of about one size, whole numbers in
    bytes. Written, so that a block is put together once."""
    dealt = rows.select(F.pmod(F.xxhash64("place"), F.lit(count)).alias("block"), "id", "place", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs in whole_runs(batches, 1):
            for start, end in runs:
                part = batch.slice(start, end - start)
                values = [[part.column(0)[0].as_py()]]
                values += [[(c.flatten() if pa.types.is_list(c.type) else c).to_numpy(zero_copy_only=False).astype("<i8").tobytes()] for c in part.columns[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, [pa.int64(), *[pa.binary()] * 3], strict=True)], names)

    kinds = ", ".join(f"{n} {k}" for n, k in zip(names, ["bigint", *["binary"] * 3], strict=True))
    return written(dealt.repartition("block").sortWithinPartitions("block", "place").mapInArrow(run, kinds), name)


def _searched(pairs: DataFrame, top: int, slack: float) -> DataFrame:
    """(query_id, query, vec_id, score): the best of every run of blocks, ``query`` being the query's place."""
    names = ["batch", "chain", "block", "ids", "places", "x", "query_ids", "query_places", "query_x"]
    rows = pairs.repartition("batch", "chain").sortWithinPartitions("batch", "chain", "block").select(*names)
    numbers = lambda value: np.frombuffer(value.as_buffer(), "<i8").astype(np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, kept = None, None

        def close():
            columns = list(zip(*[(q, p, i, s) for q, p, found in kept for s, i, _ in found], strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "query", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i] for c in range(len(names))]
                ids, places, query_ids, query_places = (numbers(row[c]) for c in (3, 4, 6, 7))
                lists = SortedLists(ids, numbers(row[5]).reshape(len(ids), -1))
                queries = numbers(row[8]).reshape(len(query_ids), -1)
                if run != (row[0].as_py(), row[1].as_py()):
                    if kept:
                        yield close()
                    run, kept = (row[0].as_py(), row[1].as_py()), [(q, p, []) for q, p in zip(query_ids.tolist(), query_places.tolist(), strict=True)]
                for (_, own, found), query in zip(kept, queries, strict=True):
                    floor = found[top - 1][0] if len(found) == top else -np.inf
                    # One place more, as the query's own row may stand among them.
                    at = lists.candidates(query, top + 1, floor, slack)
                    at = at[places[at] != own]
                    scores = lists.x[at] @ query
                    at, scores = (a[best(scores, ids[at], top)] for a in (at, scores))
                    found += zip(scores.tolist(), ids[at].tolist(), places[at].tolist(), strict=True)
                    found.sort(key=lambda f: (-f[0], f[1]))
                    del found[top:]
        if kept:
            yield close()

    return rows.mapInArrow(search, "query_id bigint, query bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, scale: int = SCALE, query_step: int = QUERY_STEP,
          block: int = BLOCK, queries: int = QUERIES, chain: int = CHAIN) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``query_step`` the ``top`` other rows with
    the highest inner product of ``floor(scale * component)``, ties to the smaller id.

    A row with a null id, a null vector or one that holds a null, NaN or infinite component takes no part; vectors are
    compared with those of their own length only, and empty ones score 0. Rows that repeat an id are queries and
    candidates each on their own: a query leaves out its own row only. Equal vectors are all candidates, however many
    there are. Other columns are not read; an empty table gives an empty table. Scores are whole
    64-bit numbers; a table in which they may not fit ends the job.

    Vectors are dealt out in blocks of about ``block`` rows, queries in batches of about ``queries``; every block meets every batch once,
    and tasks send ``top`` rows a query and chain of blocks. Nothing is cut off: bounds only leave out what cannot qualify.
    """
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v))
    # A row's place tells rows of one id apart; it is fixed by writing it.
    rows = written(rows.select("id", F.monotonically_increasing_id().alias("place"), "x"), "search-vectors")
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(
        F.count("*").alias("n"), F.sum((F.col("id") % query_step == 0).cast("long")).alias("q"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).collect()
    found = None
    for dims, n, q, most in sorted(sizes):  # one length in a well-formed table
        largest = dims * (scale * (most or 0) + 1) ** 2
        if largest >= 2**62:
            raise ValueError(f"inner products of {dims} components up to {most} may not fit 64 bits")
        if not q:
            continue
        # Bounds are sums of doubles: exact while they are below 2^53, else wide enough for what rounding may do.
        slack = 0.0 if largest < 2**53 else 4.0 * (dims + 1) * largest * 2.0**-53
        same = rows.filter(F.size("x") == dims).withColumn("x", whole)
        n_blocks, n_batches = -(-n // block), -(-q // queries)
        blocks = _blocked(same, n_blocks, ["block", "ids", "places", "x"], "search-blocks")
        asked = _blocked(same.filter(F.col("id") % query_step == 0), n_batches, ["batch", "query_ids", "query_places", "query_x"], "search-queries")
        # Every block is sent to every batch of queries.
        pairs = blocks.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_batches - 1).cast("long"))))
        pairs = pairs.withColumn("chain", F.pmod("block", F.lit(-(-n_blocks // chain)))).join(asked, "batch")
        part = _searched(pairs, top, slack)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.filter("false").select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    place = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
