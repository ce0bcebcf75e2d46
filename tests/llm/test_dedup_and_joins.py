from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from llm_cases import TEXTS, documents, expected_ids, ids_of
from pyspark.sql import functions as F

from shoptide.llm import embedding_lsh, exact_dedup, jaccard_join
from shoptide.llm.common import components, whole_runs, without


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 1)], "a long, b long"), "c").collect()}
    want = smallest({n for pair in links for n in pair}, links)
    assert {k: want[k] for k in got} == got and all(k in got for k, v in want.items() if v != k)
    assert components(spark.createDataFrame([], "a long, b long"), "c").count() == 0


def test_without_and_runs(spark):
    df = spark.createDataFrame([(i, "x") for i in [*range(50), 7, None]], "k long, v string")
    gone = spark.createDataFrame([(i,) for i in range(0, 50, 7)], "k long")
    assert sorted(str(r.k) for r in without(df, gone, ["k"]).collect()) == sorted(str(i) for i in [*[i for i in range(50) if i % 7], None])
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for size in range(1, 11):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size])], ["k"]) for i in range(0, 10, size)]
        runs = [b.column(0)[s:e].to_pylist() for b, found in whole_runs(batches, 1) for s, e in found]
        assert runs == [[1, 1], [2], [3, 3, 3, 3], [4], [5, 5]]


def plain_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    return groups


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda text: F.substring(exact_dedup.sha256(text), 1, 1)])
def test_exact_dedup_also_with_colliding_digests(spark, digest):
    rng = random.Random(2)
    rows = [(i, rng.choice([f"t{rng.randrange(30)} a  b", f"t{rng.randrange(30)} a b", "hot text", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(df, digest=digest, files_per_trigger=2).collect()}
    assert len(got) == 300
    for ids in plain_groups(rows).values():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].survivor) == (min(ids), len(ids), i == min(ids), i == min(ids))


def test_exact_dedup_odd_rows(spark):
    df = documents(spark)
    out = exact_dedup.exact_dedup(df)
    assert ids_of(out) == expected_ids()
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    assert got[3].keep_id == got[4].keep_id == 3 and got[0].keep_id == 0 and got[0].group_size == 3 and got[1].keep_id == 0
    assert sum(r.survivor for r in rows) == len(plain_groups([*enumerate(TEXTS), (99, "no id here at all"), (1, TEXTS[1])]))
    assert got[None].keep_id is None and got[None].kept
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def shingles(text, words):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def plain_join(rows, words, percent):
    """(id, set size, component) of every row; a row is a node of its own, whatever its id."""
    sets = [shingles(t, words) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = smallest(range(len(rows)), links)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(root[k], []).append(i)
    name = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(sets[k]), name[root[k]]) for k, (i, _) in enumerate(rows)), key=repr), len([k for k in range(len(rows)) if not sets[k] or root[k] == k])


def joined(df, **options):
    out = jaccard_join.jaccard_components(df, **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr), sum(r.survivor for r in out)


def near_rows(seed, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(25))
    rows = []
    for _ in range(30):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 90))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            rows.append(f"{passage} {text}" if rng.random() < 0.4 else text)
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(copies):
        words = list(base)
        words[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("words", "percent", "tile", "frequent", "hot"), [(4, 85, 1024, 16, 1 << 16), (5, 80, 8, 3, 1 << 16), (4, 85, 4, 2, 5)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, words, percent, tile, frequent, hot):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 2 if hot < 100 else 64)
    rows = near_rows(percent, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df, words=words, percent=percent) == plain_join(rows, words, percent)


def test_jaccard_join_of_missing_and_repeated_ids(spark):
    rng = random.Random(12)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    changed = lambda k: " ".join(base[:k] + ["other"] + base[k + 1 :])
    unique = " ".join(f"u{i}" for i in range(60))
    rows = [(None, changed(50)), (None, changed(120)), (None, "alone here and without an id"), (5, changed(30)), (5, unique), (2, changed(90)), (2, changed(90)), (9, unique + " end"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = joined(df)
    assert got == plain_join(rows, 4, 85)
    assert got[0].count((5, 57, 5)) == 1 and (None, 197, 2) in got[0]
    kept = [(r.doc_id, r.n_shingles) for r in jaccard_join.jaccard_components(df).filter("survivor").collect()]
    assert (5, 57) in kept and (2, 197) in kept and (None, 3) in kept and len(kept) == 5


def test_members_of_a_block_that_cannot_meet_go():
    rng = np.random.default_rng(6)
    for _ in range(200):
        size = int(rng.integers(2, 12))
        n, comp = rng.integers(1, 40, size), rng.integers(0, 4, size)
        pos = (rng.random(size) * np.array([jaccard_join.prefix_length(int(k), 80) for k in n])).astype(int)
        kept = set(jaccard_join.meeting(n, pos, comp, 80).tolist())
        for a, b in combinations(range(size), 2):
            shared = min(n[a] - pos[a], n[b] - pos[b])
            if comp[a] != comp[b] and 180 * min(shared, n[a], n[b]) >= 80 * (n[a] + n[b]):
                assert a in kept and b in kept


def test_jaccard_join_odd_rows(spark):
    df = documents(spark)
    out = jaccard_join.jaccard_components(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "survivor", "file", "row"] and ids_of(out) == expected_ids()
    rows = [*enumerate(TEXTS), (None, "no id here at all"), (1, TEXTS[1])]
    assert joined(df) == plain_join(rows, 4, 85)
    assert jaccard_join.jaccard_components(df.limit(0)).count() == 0


def test_tree_walk_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(1, 1 << 62, rng.integers(1, 120)).astype(np.uint64)
        for _ in range(rng.integers(1, 5)):
            kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1])]
            sets.append(np.unique(kept if len(kept) else base))
    sets.sort(key=len)
    tree = jaccard_join.Tree(np.stack([jaccard_join.signature(s, 1024) for s in sets]), np.array([len(s) for s in sets]))
    found = {tuple(p) for p in tree.pairs(85).tolist()}
    want = {(a, b) for a, b in combinations(range(len(sets)), 2) if jaccard_join.similar(sets[a], sets[b], 85)}
    assert want <= found and len(found) < len(sets) * (len(sets) - 1) / 4
    sets += [np.arange(k, k + n, dtype=np.uint64) << np.uint64(40) for n in (240, 255, 256, 257, 270, 500, 520, 1100) for k in (0, 3)]
    maps, n = [jaccard_join.signature(s) for s in sets], np.array([len(s) for s in sets])
    assert len({len(m) for m in maps}) > 2
    some = {tuple(sorted(p)) for p in jaccard_join.possible_pairs(maps, n, np.arange(len(sets)), 85).tolist()}
    assert {(a, b) for a, b in combinations(range(len(sets)), 2) if jaccard_join.similar(sets[a], sets[b], 85)} <= some
    sets = sets[:-16]
    group = np.array([a // 2 for a in range(len(sets))])
    assert {tuple(p) for p in tree.pairs(85, group).tolist()} >= {(a, b) for a, b in want if group[a] != group[b]}


def plain_links(ids, x, label, threshold=0.98):
    usable = [k for k, v in enumerate(x) if v is not None and label[k] is not None and ids[k] is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    unit = {k: np.array(x[k], float) / np.linalg.norm(np.array(x[k], float)) for k in usable}
    return [(a, b) for a, b in combinations(usable, 2) if label[a] == label[b] and unit[a] @ unit[b] >= threshold]


@pytest.mark.parametrize("tile", [256, 20])
def test_embeddings_against_brute_force(spark, tile):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x, label = list(base), rng.integers(0, 3, 300).tolist()
    for k in range(250):  # neighbours around the threshold, and a hot group of 100 around the first vector
        at = 0 if k < 100 else k
        noise = rng.normal(size=48)
        noise -= noise @ base[at] * base[at]
        cosine = rng.uniform(0.985, 0.999) if k < 100 else rng.uniform(0.975, 0.995)
        x.append(cosine * base[at] + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise))
        label.append(label[at])
    x += [x[5], x[5], x[5]]
    label += [label[5], label[5], None]
    x = [v.astype(np.float32).tolist() for v in x]
    x += [None, [], [0.0] * 48, [None, *x[0][1:]], [float("nan"), *x[0][1:]], [float("inf"), *x[0][1:]]]
    label += [label[0]] * 6
    ids = list(range(len(x)))
    df = spark.createDataFrame(list(zip(ids, x, label, ["c"] * len(x), strict=True)), "vec_id long, embedding array<float>, label int, vec string").withColumn("rep", F.lit("c"))
    links = plain_links(ids, x, label)
    out = embedding_lsh.near_dedup(df.repartition(3), tile=tile).collect()
    got = {r.vec_id: r for r in out}
    want = np.zeros(len(x), int)
    for a, b in links:
        want[a] += 1
        want[b] += 1
    found = np.array([got[i].n_links for i in ids])
    assert len(out) == len(x) and (found <= want).all() and found.sum() >= 0.97 * want.sum()
    if (found == want).all():
        assert {i: got[i].component_id for i in ids} == smallest(ids, links)
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_lsh.near_dedup(df).count() == 0


def test_hadamard_keeps_angles():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5, 64))
    assert np.allclose(embedding_lsh.rotated(x, 3) @ embedding_lsh.rotated(x, 3).T, x @ x.T)
