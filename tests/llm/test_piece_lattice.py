from __future__ import annotations

import math
import random

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import TEXTS, documents, expected_ids, ids_of
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from shoptide.llm import piece_lattice
from shoptide.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
MORE = ["a  b\n c \t d  ", " x", "x" * 100, "▁a ▁", "don't (stop). www.a.com 3,14 e.g.!!", "ab\u0000c"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model(spark):
    return piece_lattice.load(spark, PATH)


def table_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_ids_equal_the_library(spark, model, library):
    texts = [t for t in TEXTS if t is None or len(t) < 1000] + MORE
    _, encoded = piece_lattice.encode(table_of(spark, texts), model, frequent=8)
    got = {r["_id"]: r.ids for r in piece_lattice.assemble(encoded).collect()}
    for i, text in enumerate(texts):
        assert got.get(i, []) == library.encode(text or ""), text


def test_long_words_are_merged_as_the_library_does(spark, model, library):
    rng = random.Random(3)
    syllables = ["on", "at", "th", "er", "ing", "é", "ß", "日", "🎉", "tion", "a", "b", "▁", ".", "x"]
    words = ["".join(rng.choice(syllables) for _ in range(n)) for n in (20, 40, 63, 64, 200, 3000)] + ["a" * 63, "a" * 5000, "ab" * 700, "日本" * 90, "b" * 62]
    for word in words[:40]:
        symbols = piece_lattice.merged("▁" + word.replace("▁", "_"), model.scores)
        assert [i for s in symbols for i in ([model.scores[s][0]] if s in model.scores else [model.byte_ids[b] for b in s.encode()])] == library.encode(word.replace("▁", "_"))
    _, encoded = piece_lattice.encode(table_of(spark, words), model, frequent=4)
    got = {r["_id"]: r.ids for r in piece_lattice.assemble(encoded).collect()}
    for i, word in enumerate(words):
        assert got[i] == library.encode(word), word[:50]


def test_a_word_of_a_hundred_thousand_letters_ends(spark, model, library):
    words = ["th" * 50_000, "onatrenthe" * 10_000]
    rows = piece_lattice.summary(table_of(spark, words), model).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(w)) for i, w in enumerate(words)} and all(r.round_trip for r in rows)


def test_decoding_gives_the_text_back(spark, model):
    texts = [t for t in TEXTS if t and len(t) < 1000] + [t for t in MORE if "▁" not in t]
    _, encoded = piece_lattice.encode(table_of(spark, texts), model)
    whole = piece_lattice.assemble(encoded)
    back = piece_lattice.decode(whole, model, ["_id"]).select("_id", F.decode(F.expr("substring(surface, 2)"), "UTF-8").alias("text"))
    assert {r["_id"]: r.text for r in back.collect()} == dict(enumerate(texts))


def test_table_of_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_piece_lattice"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(t or "")) for i, t in texts.items()}
    assert all(r.round_trip for r in rows)


def test_best_path_of_a_unigram_model(spark):
    proto = model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = -math.log(2 - piece.score) if piece.score > -1e8 else -20.0
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = piece_lattice.load(spark, proto=proto.SerializeToString())
    assert not own.bpe
    texts = ["the quick brown fox jumps", "Donaudampfschifffahrt über alles", "a  b", "internationalization of words", "así domira esmira"]
    _, encoded = piece_lattice.encode(table_of(spark, texts), own)
    got = {r["_id"]: r.ids for r in piece_lattice.assemble(encoded).collect()}
    score = lambda ids: sum(proto.pieces[i].score for i in ids)
    for i, text in enumerate(texts):
        # The library adds 32-bit scores, so paths of nearly equal score may differ.
        assert score(got[i]) >= score(library.encode(text)) - 1e-3 and library.decode(got[i]) == text


def test_words_end_before_a_mark_behind_a_letter(spark, model):
    texts = {"don't (stop). a.b.c 3.14, x..y": ["▁don", "'t", "▁(stop", ").", "▁a", ".b", ".c", "▁", "3", ".", "1", "4", ",", "▁x", "..y"], "a  b ": ["▁a", "▁▁b", "▁"],
             "...é! ": ["▁...é", "!", "▁"], "·." * 20_000: ["▁" + "·." * 20_000], "a." * 2: ["▁a", ".a", "."]}
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", piece_lattice.words_of(F.col("text"), model).alias("words"))
    assert {r.text: r.words for r in rows.collect()} == texts


def test_substrings_are_no_longer_than_pieces_that_begin_so(spark, model):
    words = ["▁the", "xqxqxqxq"]
    spans = piece_lattice.edges_of(spark.createDataFrame([(w,) for w in words], "word string"), model)
    want = {(w, s, e) for w in words for s in range(len(w)) for e in range(s + 1, len(w) + 1) if e == s + 1 or w[s:e] in model.scores}
    assert {(r.word, r.start, r.start + r.len) for r in spans.collect()} == want
    reach = dict(model.reach.collect())
    assert all(reach[p[:3]] >= len(p) for p in model.scores if len(p) >= 3)
    backs = {r.word: r.back for r in piece_lattice.packed_lattice(spark.createDataFrame([("▁the",), ("▁▁▁▁a",)], "word string"), model).collect()}
    assert backs == {"▁the": False, "▁▁▁▁a": True}


def test_merges_that_go_back_to_a_better_score(spark, model):
    # With shuffled scores many pieces are better than what they are merged from; runs of space marks are so in the model itself.
    assert "▁▁▁" in piece_lattice.backward(model.scores) and "▁the" not in piece_lattice.backward(model.scores)
    proto = model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    normal = [p for p in proto.pieces if p.type == p.NORMAL]
    scores = [-float(i) for i in range(len(normal))]
    random.Random(5).shuffle(scores)
    for piece, score in zip(normal, scores, strict=True):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = piece_lattice.load(spark, proto=proto.SerializeToString())
    assert len(piece_lattice.backward(own.scores)) > 1000
    texts = ["the international organization of the thing, here and there", "así domira      esmira", "Donaudampfschifffahrt 日本 über alles", "a" * 40 + " " + "th" * 30]
    _, encoded = piece_lattice.encode(table_of(spark, texts), own, frequent=4)
    assert {r["_id"]: r.ids for r in piece_lattice.assemble(encoded).collect()} == {i: library.encode(t) for i, t in enumerate(texts)}


def test_odd_rows(spark, model, library):
    df = documents(spark)
    out = piece_lattice.summary(df, model)
    assert ids_of(out) == expected_ids()
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    assert all(got[i].n_tokens == len(library.encode(t or "")) for i, t in enumerate(TEXTS))
    assert all(r.round_trip for r in rows)
    same = [r for r in rows if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]
    assert piece_lattice.summary(df.limit(0), model).count() == 0
