from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import TEXTS, documents, expected_ids, ids_of
from tokenizers import Tokenizer

from shoptide.llm import packing, token_counts
from shoptide.llm.queries import QUERIES

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def test_counts_equal_the_library_whatever_the_split(spark, pieces):
    df = documents(spark)
    for options in ({}, {"batch_bytes": 40, "part_chars": 25}):
        out = token_counts.count_tokens(df, PIECES, **options)
        assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and ids_of(out) == expected_ids()
        got = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
        for i, text in enumerate(TEXTS):
            assert got[i].n_tokens == len(pieces.encode(text or "")), text
            assert got[i].n_bytes == len((text or "").encode()) and got[i].over_limit == (got[i].n_tokens > 4096)
    assert token_counts.count_tokens(df.limit(0), PIECES).count() == 0


def test_counts_of_the_table(spark, pieces):
    want = {r.doc_id: len(pieces.encode(r.text or "")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, SF).collect()} == want


def test_chunk_tokenizer_equals_the_library(library):
    own = packing.ChunkTokenizer(WORDS, most=20)
    texts = [t or "" for t in TEXTS] + ["Ünïcode don't I'm 12 345 ﬁ x　y Σας İstanbul é", "A.B,c!? (d) [e] a<b <|startoftext|>x", "x" * 5000]
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_tokenizer_remembers_what_is_frequent_and_little_else():
    own = packing.ChunkTokenizer(WORDS, most=100)
    learnt = []
    learn = own._learn
    own._learn = lambda: (learnt.extend(own.known.fresh), learn())
    texts = [" ".join(["often", "привет", "again,", *(f"rare{i}x{j}" for j in range(10))]) for i in range(200)]
    for at in range(0, len(texts), 2):
        got = own.encode(texts[at : at + 2])
        assert [ids.tolist() for ids in got] == [own.library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 2]]
        assert len(own.known) <= 130 and len(own.known) == own.chunk_ids.n == len(own.met)
    assert learnt.count("often") == learnt.count("привет") == learnt.count("again,") == 1


def test_index_is_bm25():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint16) for _ in range(12)]
    index, mean = packing.Index(docs), np.mean([len(d) for d in docs])
    for query in docs[:3]:
        want = []
        for doc in docs:
            score = 0.0
            for term in set(query.tolist()):
                df, tf = sum(term in d for d in docs), int((doc == term).sum())
                score += np.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean))
            want.append(score)
        assert np.allclose(index.scores(query), want)


def test_neighbours_follow_their_seed():
    a, b = np.arange(100, 400, dtype=np.uint16), np.arange(1000, 1300, dtype=np.uint16)
    order = [n for n, _ in packing.Packer(0).shard([a, b, a[:250], b[:250]])]
    assert order == [0, 2, 1, 3]


def test_related_documents_meet_whatever_their_place(spark):
    # Twins lie in the two halves of the table; a shard holds a few documents of the forty only.
    words = [f"{a}{b}" for a in ("ocean", "violin", "marble", "tiger", "castle", "engine", "pepper", "winter") for b in ("stone", "berry", "light", "craft", "house")]
    twins = [" ".join(["the house and the light of the day"] * 4 + [w] * 5) for w in words]
    df = spark.createDataFrame(list(enumerate(twins + twins)), "doc_id long, text string").repartitionByRange(4, "doc_id")
    rows = sorted(packing.pack(df, WORDS, shard_tokens=400).collect(), key=lambda r: (r.sequence_id, r.offset))
    place = {}
    for r in rows:
        place.setdefault(r.doc_id, len(place))
    near = sum(abs(place[i] - place[i + len(words)]) <= 8 for i in range(len(words)))
    assert len(place) == 80 and near >= 0.8 * len(words)


def test_statistics_are_those_of_all_documents(spark):
    docs = [np.array(d, np.uint16) for d in ([5, 5, 7], [5, 9], [7])]
    df = spark.createDataFrame([(d.tobytes(),) for d in docs], "_ids binary").repartition(3)
    stats = packing.statistics(df)
    assert (stats.n, stats.mean, stats.df[[5, 7, 9, 1]].tolist()) == (3, 2.0, [2, 2, 1, 0])
    assert packing.rare_terms(docs, stats).tolist() == [[5, 7, -1], [5, -1, -1], [7, -1, -1]]
    assert np.allclose(packing.Index(docs, stats).scores(docs[0]), packing.Index(docs).scores(docs[0]))
    assert packing.statistics(df.limit(0)).n == 0


def check_pieces(rows, texts, library):
    """Every id in one piece, gapless sequences of at most 2048, all but the last of a task full."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    used = []
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        used.append(at)
    return used


def test_packing_of_the_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    used = check_pieces(QUERIES["op5_packing"](spark, SF).collect(), texts, library)
    assert sum(u < 2048 for u in used) <= 1


def test_packing_of_odd_rows(spark, library):
    from pyspark.sql import functions as F

    df = documents(spark).coalesce(2)
    out = packing.pack(df, WORDS, shard_tokens=50).withColumn("ids_crc32", F.crc32("ids"))
    rows = [r for r in out.collect() if r.doc_id not in (None, 1)]  # id 1 is there twice
    texts = {i: t for i, t in enumerate(TEXTS) if i != 1}
    assert {r.doc_id for r in rows} == set(texts)
    for i, text in texts.items():
        assert sum(r.length for r in rows if r.doc_id == i) == len(library.encode(text or "", add_special_tokens=False).ids) + 1
    assert packing.pack(df.limit(0), WORDS).count() == 0
