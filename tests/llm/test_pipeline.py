from __future__ import annotations

import random
import re
import subprocess
import sys
from pathlib import Path

import pytest
from llm_cases import documents
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from shoptide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[2]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if re.match(r"op\d+_", n)} == {str(n) for n in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run and set(ORACLES) < set(QUERIES) < set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "exact dedup", "near dedup", "packing"]


def test_entry_works_without_the_subpackage(tmp_path):
    (tmp_path / "shoptide").mkdir()
    for path in (ROOT / "shoptide").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (tmp_path / "shoptide" / path.name).symlink_to(path)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dau_first' in q and set(q) == set(e.oracle_sql()); print(len(q))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage was given and kept, on the small table."""
    from shoptide.llm.common import written

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, docs, SF), "test-stage")
        seen.append((docs, kept))
        docs = kept
    return seen


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_stages_but_the_last_keep_the_columns(stages):
    assert all(kept.columns == corpus_pipeline.COLUMNS for _, kept in stages[:-1])


def test_filters_keep_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    given, known = stages[0]
    assert texts(known) == {i: t for i, t in texts(given).items() if any(c.isalpha() for c in t or "")}
    given, good = stages[1]
    label = {r.doc_id: r.quality for r in labels.collect()}
    gone = set(texts(given)) - set(texts(good))
    assert not [i for i in gone if label.get(i) == 1]
    assert len([i for i in texts(given) if label.get(i) == 0]) <= 1.2 * len([i for i in gone if label.get(i) == 0]) + 1


def test_the_language_decides(spark):
    from shoptide.llm.common import written

    rng = random.Random(7)
    soup = lambda letters: "".join(rng.choice(letters) for _ in range(500))
    odd = [(10**6, soup("bcdfghjklmnpqrstvwxz ")), (10**6 + 1, soup("абвгдежзик ")), (10**6 + 2, "123 456"), (10**6 + 3, None)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    more = spark.createDataFrame([(i, t, None, "s", None) for i, t in odd], docs.schema)
    kept = corpus_pipeline.keep_known_language(spark, written(docs.unionByName(more), "odd"), SF)
    assert {r.doc_id for r in kept.collect()} == {i for i, t in texts(docs).items() if any(c.isalpha() for c in t or "")}


def test_near_copies_lose_no_text_of_a_repeated_id(spark):
    from shoptide.llm.common import written

    words = [f"w{i}" for i in range(100)]
    near = " ".join([*words[:50], "other", *words[51:]])
    rows = [(5, near), (5, "a unique text that stands alone under a repeated id"), (2, " ".join(words)), (None, near + " end"), (None, "without id and alone")]
    docs = written(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"), "odd")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(2, rows[2][1]), (5, rows[1][1])]
    assert [r.text for r in kept if r.doc_id is None] == ["without id and alone"]


def test_copies_and_near_copies_go(stages):
    from test_dedup_and_joins import plain_groups, plain_join

    given, kept = (texts(df) for df in stages[2])
    assert set(kept) == {min(ids) for ids in plain_groups(given.items()).values()}
    given, kept = (texts(df) for df in stages[3])
    groups, _ = plain_join(list(given.items()), corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert set(kept) == {i for i, _, component in groups if component == i}


def test_all_that_is_left_is_packed(stages):
    given, packed = stages[4]
    rows = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect()
    assert {r.doc_id for r in rows} == set(texts(given)) and all(r.n == r.tokens for r in rows)


def test_stages_stand_odd_rows(spark):
    from shoptide.llm.common import written

    for rows in (documents(spark), documents(spark).limit(0)):
        docs = written(rows, "odd")
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), "odd-stage")
        left = {r.doc_id for r in docs.collect()}
        assert (left >= {0, None} and 1 not in left and 3 not in left) if rows.count() else not left
