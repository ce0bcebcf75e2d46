"""Importance resampling towards a target distribution, with hashed word n-grams as features.

A feature's bucket is the CRC-32 of its bytes. The distinct features of a stretch of text are grouped by length into
matrices of bytes, and all CRCs of a matrix are brought forward column by column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm.common import numbered, written

BUCKETS = 10_000
# Documents with fewer words take no part in the draw.
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
# Bytes of text that are turned into words at once, and the longest features that go into matrices: a longer one has
# bytes enough to be worth a call of its own.
STRETCH = 1 << 20
LONGEST = 64

_POLYNOMIAL = 0xEDB88320  # of CRC-32, reflected


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


def _letters() -> np.ndarray:
    """The lower-case form of every byte that belongs to a word, 0 for the others. All bytes of letters beyond ASCII do."""
    out = np.zeros(256, np.uint8)
    out[0x80:] = np.arange(0x80, 0x100)
    for first, last, to in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
        out[ord(first) : ord(last) + 1] = np.arange(ord(to), ord(to) + ord(last) - ord(first) + 1)
    return out


CRC_TABLE, LETTERS = _crc_table(), _letters()


def crc32(features: pa.Array) -> np.ndarray:
    """Unsigned CRC-32 of every value of a binary array without nulls."""
    import zlib

    ends = np.frombuffer(features.buffers()[1], np.int32, len(features) + 1, features.offset * 4).astype(np.int64)
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    start, size = ends[:-1], np.diff(ends)
    out = np.zeros(len(features), np.uint32)
    for length in np.unique(size[(size > 0) & (size <= LONGEST)]).tolist():
        at = np.flatnonzero(size == length)
        matrix = data[start[at][:, None] + np.arange(length)]
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for column in range(length):
            crc = CRC_TABLE[(crc ^ matrix[:, column]) & 0xFF] ^ (crc >> np.uint32(8))
        out[at] = ~crc
    for i in np.flatnonzero(size > LONGEST).tolist():
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]])
    return out


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes, start, end) of the words of a stretch of UTF-8."""
    low = LETTERS[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], low != 0, [False]))))
    return low, edge[::2], edge[1::2]


def _joined(low: np.ndarray, start: np.ndarray, size: np.ndarray, space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Words one after the other, with a space behind each if asked, and where each starts."""
    step = size + int(space)
    first = np.cumsum(step) - step
    out = np.full(int(step.sum()), 0x20, np.uint8)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(first, size) + at] = low[np.repeat(start, size) + at]
    return out, first


def _stretches(text: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of about ``STRETCH`` bytes that cut no word."""
    start = 0
    while start < len(text):
        end = min(len(text), start + STRETCH)
        while end < len(text) and LETTERS[text[end]]:
            nearest = np.flatnonzero(LETTERS[text[end : end + STRETCH]] == 0)
            end = end + int(nearest[0]) if len(nearest) else min(len(text), end + STRETCH)
        yield text[start:end]
        start = end


def features(texts: pa.Array, words: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, bucket of every feature, number of words by text) of stretches that follow one another.

    Features are all runs of 1 to ``words`` consecutive words joined by one space. A long text comes in several
    stretches; runs that reach over a cut are counted with the later one.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)

    def run(raw: np.ndarray, owners, carried: int):
        low, start, end = _words(raw)
        owner = owners(start)
        counts = np.bincount(owner[carried:], minlength=len(texts))
        size = end - start
        doc, bucket = [], []
        for n in range(1, words + 1):
            last = np.arange(n - 1, len(start))
            last = last[last >= carried]
            last = last[owner[last] == owner[last - (n - 1)]]
            if not len(last):
                continue
            if n == 1:
                flat, _ = _joined(low, start[last], size[last], False)
                edges = np.concatenate(([0], np.cumsum(size[last])))
            else:
                line, first = _joined(low, start, size, True)
                begin = first[last - (n - 1)]
                length = first[last] + size[last] - begin
                flat, _ = _joined(line, begin, length, False)
                edges = np.concatenate(([0], np.cumsum(length)))
            values = pa.Array.from_buffers(pa.binary(), len(last), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(flat)])
            distinct = values.dictionary_encode()
            crc = crc32(distinct.dictionary) % np.uint32(buckets)
            bucket.append(crc[distinct.indices.to_numpy(zero_copy_only=False)].astype(np.int64))
            doc.append(owner[last])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(doc or none), np.concatenate(bucket or none), counts

    i = 0
    while i < len(texts):
        j = int(np.searchsorted(ends, ends[i] + STRETCH, "right")) - 1
        if j > i:  # whole texts, a break between each two
            size = np.diff(ends[i : j + 1])
            raw, first = _joined(data, ends[i:j], size, True)
            yield run(raw, lambda start, first=first, i=i: np.searchsorted(first, start, "right") - 1 + i, 0)
            i = j
            continue
        tail = b""
        for piece in _stretches(data[ends[i] : ends[i + 1]]):
            raw = np.concatenate((np.frombuffer(tail, np.uint8), piece))
            carried = tail.count(b" ")
            yield run(raw, lambda start, i=i: np.full(len(start), i), carried)
            if words > 1:
                low, start, end = _words(raw)
                tail = b"".join(low[s:e].tobytes() + b" " for s, e in zip(start[1 - words :], end[1 - words :], strict=True))
        i += 1


def bucket_counts(docs: DataFrame, text_col: str, words: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: each task sends a number per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features(batch.column(0), words, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths of a logarithm, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def _noise(id_col: str, seed: str) -> Column:
    """Gumbel noise from the identifier, in thousandths, rounded down."""
    digits = F.substring(F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), "UTF-8"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weighted(docs: DataFrame, gain: np.ndarray, *, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n_words, n_features, weight) of every row: the mean gain of its features, rounded down, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number per bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n, sums, n_words = (np.zeros(rows, np.int64) for _ in range(3))
            for doc, bucket, found in features(batch.column(1), words, len(shared.value)):
                n_words += found
                n += np.bincount(doc, minlength=rows)
                # Texts of a stretch follow one another, so their sums are differences of a running sum.
                running = np.concatenate(([0], np.cumsum(shared.value[bucket])))
                if words == 1:
                    ends = np.cumsum(np.bincount(doc, minlength=rows))
                    sums += running[ends] - running[np.concatenate(([0], ends[:-1]))]
                else:
                    np.add.at(sums, doc, shared.value[bucket])
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in (n_words, n, weight))], ["_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"_id {kind}, n_words bigint, n_features bigint, weight bigint").withColumnRenamed("_id", id_col)


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", words: int = 1,
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: (id, n_features, weight, score, rank), rank null for rows that are not drawn.

    Words are runs of digits, ASCII letters (in lower case) and characters beyond ASCII; features are all runs of 1
    to ``words`` of them. A text's weight is the mean log ratio of its features between ``target`` and ``docs``, its
    score that and Gumbel noise of its identifier, so that the highest scores are a draw without replacement in
    proportion to the weights. Drawn are ``percent`` of the rows that have ``least_words`` words, rounded down; ties go to the
    smaller identifier, null last, then to the one with more features.

    A null text is an empty one, without features and of weight 0; texts of any length are read whole, in
    stretches; a null identifier has the noise of an empty one; rows that repeat an identifier are drawn each on
    their own; an empty ``target`` counts as one without features; an empty table gives an empty table. Other
    columns are not read, whatever their names.
    """
    gain = gains(bucket_counts(docs, text_col, words, buckets), bucket_counts(target, target_col, words, buckets))
    scored = weighted(docs, gain, id_col=id_col, text_col=text_col, words=words)
    scored = scored.withColumnRenamed(id_col, "_id").withColumn("score", F.col("weight") + _noise("_id", seed))
    scored = written(scored, "importance")
    # How many rows score higher than each score decides first: only rows that may be drawn are put in order.
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    least = _score_of_rank(able, drawn)
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("n_features").desc(), F.col("weight")]
    top = numbered(able.filter(F.col("score") >= least), order, "rank", "importance-order")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.filter((F.col("n_words") < least_words) | (F.col("score") < least)).withColumn("rank", F.lit(None).cast("long"))
    out = top.withColumn("rank", rank).select(*rest.columns).unionByName(rest)
    return out.select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")


def _score_of_rank(rows: DataFrame, rank: int) -> int:
    """The score of the row that stands at ``rank`` from the top; with rank 0 a score that no row has.

    Scores are whole thousandths of logarithms of 64-bit counts and of noise of 33 bits, so there are fewer than 10^5.
    """
    counts = rows.groupBy("score").count()
    running = counts.withColumn("seen", F.sum("count").over(Window.orderBy(F.col("score").desc())))
    found = running.filter(F.col("seen") >= rank).agg(F.max("score")).first()[0] if rank else None
    return (1 << 62) if found is None else found
