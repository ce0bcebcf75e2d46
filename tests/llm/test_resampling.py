from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, expected_ids, ids_of

from shoptide.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_buckets(text, words, buckets):
    w = plain_words(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, words + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(rows, target, words=1, buckets=50, least=3, percent=30, seed="2024"):
    found = [(i, t, plain_buckets(t, words, buckets)) for i, t in rows]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, _, b in found:
        np.add.at(s, b, 1)
    for text in target:
        np.add.at(t, plain_buckets(text, words, buckets), 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out, able = [], []
    for k, (i, text, b) in enumerate(found):
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(plain_words(text)) >= least:
            able.append(k)
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, -out[k][1], out[k][2]))
    for rank, k in enumerate(able[: percent * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=repr)


def test_crc_of_every_length():
    rng = random.Random(4)
    values = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 70), 64, 3, 3, 200, 5000]]
    for array in (pa.array(values, pa.binary()), pa.array([b"x", *values], pa.binary())[1:]):
        assert importance.crc32(array).tolist() == [zlib.crc32(v) for v in values]
    assert importance.crc32(pa.array([], pa.binary())).tolist() == []


@pytest.mark.parametrize("stretch", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("words", [1, 2, 3])
def test_features_of_stretches(monkeypatch, stretch, words):
    monkeypatch.setattr(importance, "STRETCH", stretch)
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "日本", " ", "  ", "-", "\n", "7", "🎉", "\x7f", "{"]
    texts = [None, "", "   ", "x"] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(40)] + ["a" * 300 + " b"]
    doc, bucket, counts = [], [], np.zeros(len(texts), int)
    for d, b, n in importance.features(pa.array(texts), words, 997):
        doc += d.tolist()
        bucket += b.tolist()
        counts += n
    got = [sorted(b for d, b in zip(doc, bucket, strict=True) if d == i) for i in range(len(texts))]
    assert got == [sorted(plain_buckets(t, words, 997)) for t in texts]
    assert counts.tolist() == [len(plain_words(t)) for t in texts]


@pytest.mark.parametrize("words", [1, 2])
def test_resample_equals_plain_version(spark, words):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "日本"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(12)))) for i in range(150)]
    rows += [(7, rows[7][1]), (7, "other words of a repeated id"), (None, "no id here"), (900, None), (901, ""), (902, "?! --")] + [(903, "same")] * 3
    target = [" ".join(rng.choices(vocabulary[:20], k=15)) for _ in range(8)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, bench, words=words, buckets=50, least_words=3, percent=30).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, target, words)
    ranks = sorted(r.rank for r in got if r.rank)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
    # A target of the documents' own first words draws documents with them.
    own = importance.resample(docs, bench.limit(0), words=words, buckets=50, least_words=3, percent=30)
    assert sorted(map(tuple, own.collect()), key=repr) == plain(rows, [], words)


def test_resample_odd_rows(spark):
    docs = documents(spark)
    out = importance.resample(docs, docs.select("text"), least_words=1, percent=100)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and ids_of(out) == expected_ids()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[3].n_features == rows[4].n_features == rows[13].n_features - 1 == 0 and rows[3].weight == 0 and rows[3].rank is None
    assert rows[11].n_features == 40000
    assert importance.resample(docs.limit(0), docs.select("text")).count() == 0
    assert importance.resample(docs, docs.select("text"), percent=0).filter("rank IS NOT NULL").count() == 0
