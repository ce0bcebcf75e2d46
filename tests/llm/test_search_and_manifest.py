from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from llm_cases import documents, expected_ids, ids_of
from pyspark.sql import functions as F

from shoptide.llm import manifest, topk_search


def plain_search(rows, top=5, step=50):
    usable = [(k, i, [math.floor(256 * c) for c in x]) for k, (i, x) in enumerate(rows) if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for k, i, x in usable:
        if i % step == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j) for m, j, y in usable if m != k and len(x) == len(y))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("block, queries, chain", [(4096, 256, 8), (16, 4, 2), (7, 1, 1), (300, 3, 1)])
def test_top_k_equals_brute_force(spark, block, queries, chain):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 12))
    rows = [(i, (centres[i % 4] + rng.normal(size=12) * rng.choice([0.01, 0.6])).tolist()) for i in range(240)]
    # Ties: a hot group of equal vectors, one of them a query; repeated rows and ids; rows that take no part.
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(50, rows[50][1]), (100, rows[3][1]), (7, [0.0] * 12), (150, [0.0] * 12)]
    rows += [(200, None), (250, [1.0] * 11 + [None]), (300, [1.0] * 11 + [float("nan")]), (350, [float("inf")] + [0.0] * 11), (None, rows[1][1])]
    rows += [(400, [1.0, 2.0]), (401, [0.5, -1.0]), (450, []), (451, []), (500, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "place", "block", "x", "score", "rank")})
    got = topk_search.top_k(df.repartition(3), block=block, queries=queries, chain=chain)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == plain_search(rows)


def test_top_k_of_large_values_and_of_nothing(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(2e5, 4e5) for _ in range(16)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(topk_search.top_k(df, block=16)) == plain_search(rows)
    assert topk_search.top_k(df.limit(0)).count() == 0
    assert topk_search.top_k(df.filter("vec_id % 50 <> 0")).count() == 0
    with pytest.raises(ValueError):
        topk_search.top_k(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>"))


def test_lists_are_not_read_to_the_end():
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(2000, 8)) * 256).astype(np.int64)
    lists = topk_search.SortedLists(np.arange(2000), x)
    read = []
    plain_sums = lists._sums
    lists._sums = lambda rows, start, end, *rest: read.append(end) or plain_sums(rows, start, end, *rest)
    best = np.argsort(-(x @ x[5]), kind="stable")[:5]
    found = lists.candidates(x[5], 5, -np.inf)
    assert set(best) <= set(found) and len(found) < 2000 and max(read) < 2000
    floor = (x @ x[5])[best[4]]
    read.clear()
    found = lists.candidates(x[5], 5, floor)
    assert set(best) <= set(found) and max(read) < 1000


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, place):
    path = []
    for level in levels[:-1]:
        run = level[place - place % 3 : place - place % 3 + 3]
        path.append((run[: place % 3], run[place % 3 + 1 :]))
        place //= 3
    return path


def plain_manifest(rows):
    groups = {}
    for r in rows:
        i, text, *_ = r
        values = lambda t, r=r: [r[0], r[3], r[2], r[4], t]
        leaf = sha("".join(map(plain_field, values(text))))
        changed = text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        groups.setdefault(r[3], []).append((i is not None, i or 0, leaf, sha("".join(map(plain_field, values(text.replace("\n", ""))))) if changed else leaf, i))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([g[2] for g in sorted(groups[s])]) for s in order}
    upper = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for k, (_, _, leaf, start, i) in enumerate(sorted(groups[s])):
            path = plain_path(trees[s], k) + plain_path(upper, place)
            again = start
            for left, right in path:
                again = sha("".join([*left, again, *right]))
            root = upper[-1][0]
            out.append((i, leaf, trees[s][-1][0], root, sha("".join("".join(a + b) for a, b in path)), again, again == root))
    return sorted(out, key=repr)


def manifest_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return sorted((tuple(r) for r in manifest.manifest(df.repartition(4), **options).collect()), key=repr)


def test_manifest_equals_plain_version(spark, monkeypatch):
    rng = random.Random(10)
    ids = rng.sample(range(-500, 3000), 900) + [2**40 + i * 4097 for i in range(30)] + [-(2**50), 2**62]
    rows = [(i, rng.choice(["a\nb", f"t{i}", "", None, "é\n\n"]), rng.choice(["en", None]), rng.choice(["hot"] * 5 + ["a", "é", None, ""]), rng.choice([i % 7, None])) for i in ids]
    rows += [(12345, "lone", "en", "lone source", 1)]
    assert manifest_of(spark, rows) == plain_manifest(rows)
    # Passes of few slots, so that trees of several passes are seen; directories of several levels.
    monkeypatch.setattr(manifest, "DIRECTORY_BITS", 4)
    assert manifest_of(spark, rows[:400], levels=2) == plain_manifest(rows[:400])


def test_manifest_of_repeated_and_missing_ids(spark):
    rng = random.Random(11)
    rows = [(rng.choice([None, 1, 2, 63, 64, -1]), rng.choice(["x\ny", "x", None, f"u{i}"]), "en", rng.choice(["a", None]), 3) for i in range(300)]
    rows += [(5, "alone", "en", "a", 3), (None, "same", "en", "a", 3), (None, "same", "en", "a", 3)]
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_manifest_odd_rows(spark):
    out = manifest.manifest(documents(spark))
    assert ids_of(out) == expected_ids()
    assert manifest.manifest(documents(spark).limit(0)).count() == 0
    one = spark.createDataFrame([(4, "t\n", "en", "s", 2)], "doc_id long, text string, lang string, source string, n_chars long")
    row = manifest.manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("") and row.verified == (zlib.crc32(b"4") % 2 == 1)
