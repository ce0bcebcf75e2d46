"""Near-duplicate embeddings by cross-polytope hashing: fast Hadamard rotations, multiprobe buckets, exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import components, whole_runs, written

THRESHOLD = 0.98
# Tables, hashes that make up a bucket of a table, and buckets of each table that a vector enters.
TABLES, HASHES, PROBES = 6, 2, 3
# Larger buckets are cut into tiles of about this many vectors, and each pair of tiles is compared on its own.
TILE = 256


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows of ``x`` (width a power of two) after three rounds of random signs and a fast Hadamard transform."""
    signs = np.random.default_rng(seed).integers(0, 2, (3, x.shape[1])) * 2.0 - 1
    for s in signs:
        x = x * s
        half = 1
        while half < x.shape[1]:
            y = x.reshape(len(x), -1, 2, half)
            x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), -1)
            half *= 2
        x = x / np.sqrt(x.shape[1])
    return x


def bucket_keys(x: np.ndarray, label: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """(row, tables * probes) bucket keys. A hash is the vertex of the cross-polytope nearest to the rotated vector,
    the signed axis of the largest coordinate; the probes of a table are its bucket and those reached by
    taking the second-nearest vertex in one of its hashes, the smallest loss first."""
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rows = np.arange(len(x))
    out = np.empty((len(x), tables * probes), np.int64)
    for t in range(tables):
        best, second, loss = [], [], []
        for h in range(hashes):
            y = rotated(x, 1000 * t + h)
            size = np.abs(y)
            a = size.argmax(axis=1)
            top = size[rows, a]
            size[rows, a] = -1
            b = size.argmax(axis=1)
            best.append(2 * a + (y[rows, a] < 0))
            second.append(2 * b + (y[rows, b] < 0))
            loss.append(top - size[rows, b])
        order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")
        for p in range(probes):
            key = label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t + 1)
            for h in range(hashes):
                swap = (order[:, p - 1] == h) if 0 < p <= hashes else np.zeros(len(x), bool)
                key = (key ^ np.where(swap, second[h], best[h]).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(29)
            out[:, t * probes + p] = key.view(np.int64)
    return out


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column without nulls, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1 if width is None else width)


def _hashed(classes: DataFrame, dims: int, tables: int, hashes: int, probes: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(3), dims).astype(np.float64)
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            found = bucket_keys(x / np.linalg.norm(x, axis=1, keepdims=True), label, tables, hashes, probes)
            ends = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], [*batch.schema.names, "keys"])

    return classes.select("rep", "label", "weight", "vec").mapInArrow(keys, "rep bigint, label bigint, weight bigint, vec array<double>, keys array<bigint>")


def bucket_links(reps: np.ndarray, weights: np.ndarray, x: np.ndarray, keys: np.ndarray, own: np.ndarray, key: int, pair: tuple[int, int], threshold: float):
    """(rep, weight of the linked classes, root) of one bucket or pair of tiles. A pair of vectors counts in the
    smallest bucket that both have, and in the pair of their own tiles, so once in all. Roots connect the
    documents as the pairs counted here do."""
    cosine = x @ x.T
    a, b = np.nonzero(np.triu(cosine >= threshold, 1))
    right = (np.minimum(own[a], own[b]) == pair[0]) & (np.maximum(own[a], own[b]) == pair[1])
    a, b = a[right], b[right]
    owned = np.zeros(len(a), bool)
    for start in range(0, len(a), 1 << 14):
        i, j = a[start : start + (1 << 14)], b[start : start + (1 << 14)]
        both = (keys[i][:, :, None] == keys[j][:, None, :]).any(axis=2)
        first = np.where(both, keys[i], np.iinfo(np.int64).max).min(axis=1)
        owned[start : start + (1 << 14)] = first == key
    a, b = a[owned], b[owned]
    links = np.bincount(a, weights[b], len(reps)) + np.bincount(b, weights[a], len(reps))
    root = np.arange(len(reps))
    while len(a):
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (before == root).all():
            break
    some = links > 0
    return reps[some], links[some].astype(np.int64), reps[root[some]]


def _compared(rows: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Runs of equal (key, lo, hi) in sorted partitions, one after the other."""
    names = ["key", "lo", "hi", "own", "rep", "weight", "vec", "keys"]
    sorted_rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep").select(*names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs in whole_runs(batches, 3):
            key, lo, hi, own, rep, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            x = _matrix(batch.column(6), dims).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            keys = _matrix(batch.column(7))
            found = [bucket_links(rep[f:e], weight[f:e], x[f:e], keys[f:e], own[f:e], key[f], (lo[f], hi[f]), threshold) for f, e in runs if e - f > 1]
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["rep", "links", "root"])

    return sorted_rows.mapInArrow(compare, "rep bigint, links bigint, root bigint")


def near_dedup(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
               threshold: float = THRESHOLD, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: (id, n_links, component_id, kept).

    Vectors are compared when their labels are equal and not null, by cosine in double precision; a link has a
    cosine of ``threshold`` or more. Vectors that are null, empty or zero or hold a null, NaN or infinite
    component link with nothing, nor do rows with a null id. Equal vectors of a label are linked and joined as
    one class, however many there are. Vectors of other lengths than the table's first length class are
    compared within their length only. Rows that repeat an id are one node of the components. Other columns
    are not read; an empty table gives an empty table.

    Links of unequal vectors are found when they share a bucket of any table; recall is measured in the tests.
    Every pair that shares a bucket is compared: there is no cap on buckets, large ones are dealt out in tiles.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vec", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    good = rows.filter("usable").select("_id", "label", F.transform("vec", lambda v: v + F.lit(0.0)).alias("vec"))
    classes = written(good.groupBy("label", "vec").agg(F.min("_id").alias("rep"), F.count("*").alias("weight")), "vector-classes")

    found = None
    for (dims,) in sorted(classes.select(F.size("vec")).distinct().collect()):  # one width in a well-formed table
        same = classes.filter(F.size("vec") == dims)
        hashed = written(_hashed(same, dims, tables, hashes, probes), "vector-buckets")
        postings = hashed.withColumn("key", F.explode(F.array_distinct("keys")))
        counts = postings.groupBy("key").count().filter("count > 1")
        tiled = postings.join(counts, "key").withColumn("tiles", F.ceil(F.col("count") / tile)).withColumn("own", F.pmod(F.xxhash64("rep"), "tiles"))
        tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        tiled = tiled.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
        part = _compared(tiled, dims, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "vector-links")
    comps = components(found.selectExpr("rep AS a", "root AS b"), "components").withColumnRenamed("node", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # Without the vectors: one row per member with the id of its class.
    named = good.join(classes, ["label", "vec"]).select("_id", "rep", "weight")
    named = named.join(links, "rep", "left").join(comps, "rep", "left").select(
        "_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    rest = rows.filter(~F.col("usable")).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    out = named.unionByName(rest)
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
