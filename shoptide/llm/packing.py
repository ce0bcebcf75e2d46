"""Packing of documents into token sequences: each seed document's window is filled with its lexical neighbours,
found in a sharded BM25 index with the statistics of the whole table."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import written

WINDOW = 2048
END_ID = 1
# A shard of the index: a stretch of the documents in the order of their rare terms, closed at this many tokens.
SHARD_TOKENS = 1 << 18
# White space of Python that is none for the tokenizer; such texts are encoded as a whole.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
LATIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
K1, B = 1.2, 0.75
# Rare terms that decide where a document is put.
KEYS = 3
# Chunks that a task's tokenizer remembers; each takes about 300 bytes, its word included.
REMEMBERED = 150_000
# Chunks that the library encodes at once: what it returns for each is much larger than the ids.
ENCODED_AT_ONCE = 4096


class _Known(dict):
    """Chunk -> number; asking for an unknown chunk gives it the next number and notes it."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number


class ChunkTokenizer:
    """Ids of texts by a tokenizers file whose pre-tokenizer drops white space.

    No token reaches over white space, so the ids of a text are those of its chunks, one after the other. Each
    distinct chunk is encoded once by the library and remembered, about ``most`` of them at a time; when there are more,
    those that were met once are forgotten, so that what is frequent is not encoded anew. Most chunks
    are a word of Latin letters with punctuation behind it: words are encoded once in lower case, and the chunk's
    ids are the word's and then the punctuation's.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.words_only = Tokenizer(self.library.model)
        self.words_only.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most = most
        self.known, self.words = _Known(), _Known()
        self.chunk_ids, self.word_ids = _Flat(), _Flat()
        self.met = np.zeros(0, np.int64)  # by chunk

    def _forget(self) -> None:
        """Keep the chunks that were met most, at least twice, up to half of ``most``."""
        often = np.flatnonzero(self.met > 1)
        kept = np.sort(often[np.argsort(-self.met[often], kind="stable")[: self.most // 2]])
        chunks, ids = list(self.known), _Flat()  # in the order of their numbers
        ids.add(self.chunk_ids.of(kept), self.chunk_ids.lengths(kept))
        self.known = _Known()
        self.known.update((chunks[number], i) for i, number in enumerate(kept.tolist()))
        self.chunk_ids, self.met = ids, np.ones(len(kept), np.int64)
        self.words, self.word_ids = _Known(), _Flat()

    def _learn(self) -> None:
        """Ids of the fresh chunks, in the order of their numbers."""
        chunks, self.known.fresh = self.known.fresh, []
        pairs = np.full((len(chunks), 2), -1, np.int64)
        odd = []
        for i, chunk in enumerate(chunks):
            if match := LATIN_WORD.fullmatch(chunk):
                word, marks = match.groups()
                pairs[i, 0] = self.words[word.lower()]
                if marks:
                    pairs[i, 1] = self.words[marks]
            else:
                odd.append(i)
        fresh, self.words.fresh = self.words.fresh, []
        for at in range(0, len(fresh), ENCODED_AT_ONCE):
            part = fresh[at : at + ENCODED_AT_ONCE]
            ids = np.array(self.words_only.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint16)
            self.word_ids.add(ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1))
        lengths = np.where(pairs >= 0, self.word_ids.lengths(pairs), 0)
        lone = {}
        for at in range(0, len(odd), ENCODED_AT_ONCE):
            part = odd[at : at + ENCODED_AT_ONCE]
            lone.update((i, np.array(e.ids, np.uint16)) for i, e in zip(part, self.library.encode_batch([chunks[i] for i in part], add_special_tokens=False), strict=True))
        # The odd chunks' ids go into their places among the others'.
        own = np.array([len(lone[i]) for i in odd], np.int64)
        total = lengths.sum(axis=1)
        total[odd] = own
        flat = np.zeros(int(total.sum()), np.uint16)
        plain = np.repeat(pairs[:, 0] >= 0, total)
        some = (pairs >= 0).ravel()
        flat[plain] = self.word_ids.of(pairs.ravel()[some])
        if odd:
            flat[~plain] = np.concatenate([lone[i] for i in odd])
        self.chunk_ids.add(flat, total)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = {i for i, t in enumerate(texts) if any(c in t for c in ODD_SPACE)}
        split = [[] if i in odd else t.split() for i, t in enumerate(texts)]
        if len(self.known) > self.most:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        met = np.bincount(at, minlength=len(self.known))
        met[: len(self.met)] += self.met
        self.met = met
        if self.known.fresh:
            self._learn()
        ids = self.chunk_ids.of(at)
        ends = np.concatenate(([0], np.cumsum(self.chunk_ids.lengths(at))))[np.cumsum([0] + [len(p) for p in split])]
        out = [ids[ends[i] : ends[i + 1]] for i in range(len(texts))]
        for i in odd:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint16)
        return out


class _Flat:
    """Arrays of ids by number, one behind the other."""

    def __init__(self):
        self.ids = np.zeros(1 << 16, np.uint16)
        self.ends = np.zeros(1 << 15, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        size = int(self.ends[self.n])
        while size + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.n + len(lengths) >= len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[size : size + len(ids)] = ids
        self.ends[self.n + 1 : self.n + 1 + len(lengths)] = size + np.cumsum(lengths)
        self.n += len(lengths)

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.ends[numbers + 1] - self.ends[numbers]

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self.ids[gather(self.ends[numbers], self.lengths(numbers))]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + length), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


@dataclass
class Statistics:
    """Of all documents: their number, their mean length, and term -> number of documents with it."""

    n: int
    mean: float
    df: np.ndarray

    def idf(self, terms: np.ndarray) -> np.ndarray:
        return np.log1p((self.n - self.df[terms] + 0.5) / (self.df[terms] + 0.5))


def postings(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the document, term, frequency), sorted by document and term."""
    keys = np.concatenate(docs).astype(np.int64)
    keys += np.repeat(np.arange(len(docs), dtype=np.int64) << 16, [len(d) for d in docs])
    keys.sort()
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new] >> 16, keys[new] & 0xFFFF, np.diff(new, append=len(keys))


def rare_terms(docs: list[np.ndarray], stats: Statistics) -> np.ndarray:
    """(document, KEYS): its terms of the greatest BM25 weight that another document has too, best first; -1 for none."""
    number, term, tf = postings(docs)
    sizes = np.array([len(d) for d in docs])
    weight = stats.idf(term) * tf * (K1 + 1) / (tf + (K1 * (1 - B + B * sizes / max(stats.mean, 1)))[number])
    weight[stats.df[term] < 2] = -1
    order = np.lexsort((term, -weight, number))
    starts = np.searchsorted(number, np.arange(len(docs)))
    at = starts[:, None] + np.arange(KEYS)
    inside = at < np.append(starts[1:], len(number))[:, None]
    best = order[np.minimum(at, len(number) - 1)]
    return np.where(inside & (weight[best] >= 0), term[best], -1)


class Index:
    """BM25 over the documents of one shard; terms are token ids. Without ``stats`` the statistics are the shard's."""

    def __init__(self, docs: list[np.ndarray], stats: Statistics | None = None):
        n = len(docs)
        sizes = np.array([len(d) for d in docs])
        keys = np.concatenate(docs).astype(np.int64 if n >> 15 else np.int32)
        keys *= n
        keys += np.repeat(np.arange(n, dtype=keys.dtype), sizes)
        keys.sort()
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        tf = np.diff(new, append=len(keys))
        term, self.doc = np.divmod(keys[new], n)
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        self.terms, df = term[first], np.diff(first, append=len(term))
        self.first, self.df, self.n = first, df, n
        idf = stats.idf(self.terms) if stats else np.log1p((n - df + 0.5) / (df + 0.5))
        damp = K1 * (1 - B + B * sizes / max(stats.mean if stats else sizes.mean(), 1))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + damp[self.doc])

    def scores(self, doc: np.ndarray) -> np.ndarray:
        """The score of every document of the shard for the terms of ``doc``."""
        at = np.searchsorted(self.terms, np.unique(doc))
        postings = gather(self.first[at], self.df[at])
        return np.bincount(self.doc[postings], weights=self.weight[postings], minlength=self.n)


class Packer:
    """Fills one window after the other; what is open stays open from shard to shard."""

    def __init__(self, task: int, stats: Statistics | None = None):
        self.stats = stats
        self.next_id = task << 32
        self.room = WINDOW

    def place(self, doc: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Pieces (start, length, sequence, offset) of a document, from the open window on."""
        start = 0
        while start < len(doc):
            length = min(self.room, len(doc) - start)
            yield start, length, self.next_id, WINDOW - self.room
            start += length
            self.room -= length
            if not self.room:
                self.next_id += 1
                self.room = WINDOW

    def shard(self, docs: list[np.ndarray]) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
        """Every document once, as (number, piece). The first unused document is the seed; its unused neighbours
        follow by falling score (ties: by position) until its last window is full. The document that is cut at the
        end of a window opens the next one and is the next seed."""
        index = Index(docs, self.stats)
        unused = np.ones(len(docs), bool)
        seed, at = None, 0
        while True:
            if seed is None:
                while at < len(docs) and not unused[at]:
                    at += 1
                if at == len(docs):
                    return
                seed = at
                unused[at] = False
                for piece in self.place(docs[at]):
                    yield at, piece
                if self.room == WINDOW:
                    seed = None
                    continue
            scores = np.where(unused, index.scores(docs[seed]), -1)
            window, cut = self.next_id, None
            for near in np.argsort(-scores, kind="stable"):
                if scores[near] < 0:
                    return
                unused[near] = False
                for piece in self.place(docs[near]):
                    yield int(near), piece
                if self.next_id != window:
                    cut = int(near)
                    break
            if cut is None:
                return
            seed = cut if self.room < WINDOW else None


def pack(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all rows in sequences of at most
    2048 ids.

    A row's ids are those of its text and then ``END_ID``; a null text is an empty one, with that id alone. ``ids``
    holds the piece as little-endian unsigned 32-bit numbers. Every id lies in one piece and every window but the
    last of a task is full. Repeated rows are packed each on its own; null identifiers are kept; other columns are
    not read; an empty table gives an empty table.

    Document frequencies and the mean length are those of all rows. Rows are dealt out by range over their
    ``KEYS`` rarest terms and their place, so that documents which share them come together whatever file they were in, and
    a group of any size is spread over tasks by its further terms and then by its rows. A shard of the index is a stretch
    of that order with about ``shard_tokens`` ids, which bounds memory; neighbours are sought in it only.
    """
    tokens = written(_tokenized(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")), path), "packing")
    shared = tokens.sparkSession.sparkContext.broadcast(statistics(tokens))  # a number per token of the vocabulary
    order = [*[f"_k{k}" for k in range(KEYS)], "_at"]
    dealt = _keyed(tokens, shared).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = dealt.select("_id", "_ids")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId(), shared.value)
        ids: list = []
        shard: list[np.ndarray] = []
        held = 0

        def close():
            found: list[tuple] = []
            for number, (start, length, sequence, offset) in packer.shard(shard):
                doc = shard[number]
                found.append((ids[number], start, length, doc[start : start + length].astype("<u4").tobytes(), len(doc), sequence, offset))
            columns = list(zip(*found, strict=True))
            kinds = [id_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)

        for batch in batches:
            id_kind = batch.column(0).type
            for name, doc in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), strict=True):
                ids.append(name)
                shard.append(doc)
                held += len(doc)
                if held >= shard_tokens:
                    yield from close()
                    ids, shard, held = [], [], 0
        if shard:
            yield from close()
        del shard, ids
        pa.default_memory_pool().release_unused()

    id_type = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(pieces, schema).withColumnRenamed("_id", id_col)


NAMES = ["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(ids, "<u2") for ids in column.to_pylist()]


def _tokenized(rows: DataFrame, path: str) -> DataFrame:
    """(_id, _at, _ids): ids as unsigned 16-bit numbers with ``END_ID`` behind; ``_at`` tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = ChunkTokenizer(path)  # it goes with the task, as other stages use the same workers
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                docs = [np.append(doc, np.uint16(END_ID)).astype("<u2").tobytes() for doc in tokenizer.encode(part.column(1).to_pylist())]
                places = pa.array(np.arange(at, at + len(docs)))
                at += len(docs)
                yield pa.RecordBatch.from_arrays([part.column(0), places, pa.array(docs, pa.binary())], ["_id", "_at", "_ids"])
        del tokenizer
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _at bigint, _ids binary")


def statistics(tokens: DataFrame) -> Statistics:
    """Of all documents (_ids); each task sends a number per token of the vocabulary at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, size = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            docs = _arrays(batch.column(0))
            if docs:
                df += np.bincount(postings(docs)[1], minlength=1 << 16)
                n += len(docs)
                size += sum(map(len, docs))
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *terms.tolist()], pa.int64()), pa.array([size, n, *df[terms].tolist()], pa.int64())], ["term", "n"])

    found = tokens.select("_ids").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r.term: r.n for r in found}
    size, n = counts.pop(-2, 0), counts.pop(-1, 0)
    df = np.zeros(1 << 16, np.int64)
    df[list(counts)] = list(counts.values())
    return Statistics(n, size / max(n, 1), df)


def _keyed(tokens: DataFrame, shared) -> DataFrame:
    """``tokens`` with the rare terms of each row as ``_k0``, ``_k1``, ..."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = rare_terms(_arrays(batch.column(2)), shared.value)
                columns = [pa.array(keys[:, k].astype(np.int32)) for k in range(KEYS)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *[f"_k{k}" for k in range(KEYS)]])

    fields = ", ".join(f"_k{k} int" for k in range(KEYS))
    return tokens.select("_id", "_at", "_ids").mapInArrow(run, f"_id {tokens.schema['_id'].dataType.simpleString()}, _at bigint, _ids binary, {fields}")
