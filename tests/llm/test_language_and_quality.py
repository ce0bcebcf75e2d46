from __future__ import annotations

import numpy as np
import pytest
from llm_cases import TEXTS, documents, expected_ids, ids_of
from pyspark.sql import functions as F

from shoptide.llm import language_id, quality
from shoptide.llm.queries import QUERIES, held_out

SF = "/root/testdata/sf0.01"


def plain_phrases(sample, text):
    """Greedy longest-match parse by substring search."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(end - 1, at + 1)
        count += 1
    return count


@pytest.mark.parametrize("dense", [2, 64])
def test_parse_equals_substring_search(monkeypatch, dense):
    monkeypatch.setattr(language_id, "DENSE", dense)
    rng = np.random.default_rng(3)
    samples = {lang: "".join(rng.choice(list("abc "), 200)) for lang in "xyz"}
    model = language_id.build(samples)
    texts = ["".join(rng.choice(list("abcd "), rng.integers(1, 90))) for _ in range(40)]
    got = language_id.phrases(model, [np.array([model.codes.get(c, model.alphabet - 1) for c in t]) for t in texts])
    # A letter that the sample lacks ends a phrase and stands in it alone; the next phrase begins after it.
    for text, row in zip(texts, got.tolist(), strict=True):
        for (_, sample), n in zip(samples.items(), row, strict=True):
            assert abs(plain_phrases(sample, text) - n) <= text.count("d") + 1
            if "d" not in text:
                assert plain_phrases(sample, text) == n


def test_ten_large_alphabets_fit():
    rng = np.random.default_rng(4)
    samples = {f"l{k}": "".join(chr(0x4E00 + 2000 * k + int(c)) for c in rng.integers(0, 3000, 12_000)) for k in range(10)}
    model = language_id.build(samples)
    assert sum(x.nbytes for x in (model.table, model.keys, model.targets)) < 200 << 20
    for k, sample in enumerate(samples.values()):
        text = sample[500:600] + "q" + sample[9000:9050]
        row = language_id.phrases(model, [np.array([model.codes.get(c, model.alphabet - 1) for c in text])])[0]
        assert row[k] == 2 and row.argmin() == k and row.max() > 100


def test_sample_holds_a_passage_of_every_picked_text(spark):
    # Each text repeats a letter pair of its own; the hot text is there more often than the sample has texts.
    letters = [chr(0x4E00 + i) for i in range(150)]
    rows = [(f"{c}。" * 40 + f"{c}終" * 200, "zh") for c in letters] + [("熱い " * 50, "zh")] * 400
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    assert set(letters) <= set(model.codes) and "終" in model.codes
    assert len(model.table) <= 2 * language_id.SAMPLE_CHARS
    few = language_id.train(spark.createDataFrame([("ab " * 9000, "x"), ("short", "x")], "text string, lang string"), sample_chars=600)
    assert language_id.phrases(few, [np.array([few.codes[c] for c in "ab " * 100])]).tolist() == [[1]] and set("short") <= set(few.codes)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    out = QUERIES["op3_language_id"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 350
    assert np.mean([r.lang_pred == r.truth for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_and_no_training_rows(spark):
    df = documents(spark)
    labelled = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(labelled.filter(~held_out()))
    out = language_id.predict(df, model)
    got = {r.doc_id: r for r in out.collect()}
    assert ids_of(out) == expected_ids()
    for i, text in enumerate(TEXTS):
        no_letter = not any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == no_letter and (got[i].score == 0) == no_letter
    kept = language_id.predict(df, model, keep=["doc_id", "text", "lang_pred", "_id"])
    assert kept.columns == ["doc_id", "text", "_id", "lang_pred", "score", "known"] and kept.count() == len(expected_ids())
    nothing = language_id.train(df.filter("lang = 'no such'"))
    assert {r.lang_pred for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0


def test_texts_of_no_learned_language_are_told_by_their_rate(spark):
    labelled = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(labelled.filter(~held_out()))
    model = language_id.calibrated(model, labelled.filter(~held_out()))
    assert np.isfinite(model.cuts).all()
    found = language_id.predict(labelled, model, keep=["doc_id", "lang", "text"]).collect()
    spoken = [r for r in found if sum(c.isalpha() for c in r.text) >= language_id.LEAST_LETTERS]
    assert np.mean([r.known for r in spoken]) >= 0.99 and all(r.known for r in found if r not in spoken and r.lang_pred != "und")
    rng = np.random.default_rng(5)
    soup = ["".join(rng.choice(list(letters), 600)) for letters in ("bcdfghjklmnpqrstvwxz ", "абвгдежзик ", "αβγδεζηθ ", "abcdefghijklmnopqrstuvwxyz      ")]
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([*soup, "xqzzk", None, "42"])], "doc_id long, text string")
    got = {r.doc_id: r.known for r in language_id.predict(odd, model).collect()}
    assert not any(got[i] for i in range(len(soup))) and got[4] and not got[5] and not got[6]
    # Without texts of another language nothing can be told.
    alone = labelled.filter("lang = 'en'")
    assert np.isinf(language_id.calibrated(language_id.train(alone), alone).cuts).all()
    assert len(language_id.calibrated(language_id.train(alone.limit(0)), alone.limit(0)).cuts) == 0


def test_cuts_are_those_of_all_labelled_texts_as_wholes(spark):
    rng = np.random.default_rng(3)
    some = spark.read.parquet(f"{SF}/documents.parquet").filter("lang IS NOT NULL AND length(text) > 300").orderBy("doc_id").limit(60).collect()
    # The second part of each text is of another kind than the first and longer than any passage.
    rows = [(r.text + " " + "".join(rng.choice(list("abcdefghij "), 9000 if i % 2 else 100)), r.lang) for i, r in enumerate(some)]
    labelled = spark.createDataFrame([*rows, *rows[:20]], "text string, lang string")
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    found = {(r.at, r.lang): r.rates for r in language_id.predict(labelled.withColumn("at", F.xxhash64("text")), model, id_col="at", keep=["lang"], rates=True).collect()}
    cuts = language_id.calibrated(model, labelled).cuts
    for k, lang in enumerate(model.langs):
        own, other = (sorted(r[k] for (_, of), r in found.items() if (of == lang) == same) for same in (True, False))
        if own and other:
            lower = lambda rates, share: rates[int(share * (len(rates) - 1))]
            assert abs(cuts[k] - max(language_id.FOREIGN * lower(other, 0.5), lower(own, language_id.OWN))) < 1 / language_id.RATE_STEPS
    assert np.isfinite(cuts).any()


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op6_quality"](spark, SF).join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").collect()
    good = [r for r in rows if r.label == 1]
    assert np.mean([r.kept for r in good]) >= 0.99
    assert np.mean([not r.kept for r in rows if r.label == 0]) >= 0.9



def plain_priors(rows, offset):
    """(site_prior, quality) of each (host, path, evidence), by loops over hosts and paths."""
    p = [1 / (1 + np.exp(-(e + offset))) for _, _, e in rows]
    mean = sum(p) / len(p)

    def strength(groups):
        several = [(n, s, above) for n, s, above in groups if n > 1]
        if not several:
            return 10.0
        spread = sum(n * (s / n - above) ** 2 for n, s, above in several)
        chance = sum(above * (1 - above) for _, _, above in several)
        every = sum(n * above * (1 - above) for n, _, above in several)
        return 1 / min(max((spread - chance) / max(every - chance, 1e-12), 1e-3), 0.999) - 1

    def sums(key):
        out = {}
        for (host, path, _), x in zip(rows, p, strict=True):
            n, s = out.get(key(host, path), (0, 0.0))
            out[key(host, path)] = (n + 1, s + x)
        return out

    hosts, paths = sums(lambda h, q: h), sums(lambda h, q: (h, q))
    over_hosts = strength([(n, s, mean) for n, s in hosts.values()])
    host_mean = {h: (s + over_hosts * mean) / (n + over_hosts) for h, (n, s) in hosts.items()}
    over_paths = strength([(n, s, host_mean[h]) for (h, _), (n, s) in paths.items()])
    out = []
    for (host, path, evidence), x in zip(rows, p, strict=True):
        n, s = paths[host, path]
        prior = min(max((s - x + over_paths * host_mean[host]) / (n - 1 + over_paths), 0), 1)
        safe = min(max(prior, 1e-6), 1 - 1e-6)
        out.append((prior, 1 / (1 + np.exp(-(evidence + np.log(safe / (1 - safe)))))))
    return out


def test_priors_equal_plain_loops(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    docs = docs.withColumn("path", F.concat_ws("/", "source", F.pmod("doc_id", F.lit(7)).cast("string")))
    out = quality.quality(docs, labels, host=F.col("source"), path=F.col("path"), keep=["doc_id", "source", "path"]).collect()
    rows = [(r.source or "", r.path or "", r.evidence) for r in out]
    want = plain_priors(rows, quality.train(docs, labels).offset)
    assert np.allclose([(r.site_prior, r.quality) for r in out], want, atol=1e-9)
    assert [r.kept for r in out] == [q >= 0.5 for _, q in want]


def test_sparse_sites_are_drawn_to_the_level_above(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        host = "bad" if i < 200 else "good"
        junk = rng.random() < (0.9 if host == "bad" else 0.02)
        rows.append((i, "A!! B!! C!! " * 20 if junk else "some plain words here. " * 12, host, "p"))
        labels.append((i, int(not junk)))
    rows += [(1000, "x y", "bad", "new"), (1001, "x y", "good", "new"), (1002, "x y", "unseen", "new"), (1003, None, None, None), (1004, "x y", "good", "p"), (1004, "x y", "good", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").withColumns({"evidence": F.lit("x"), "n": F.lit("x"), "s": F.lit("x")})
    known = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, quality int")
    out = quality.quality(docs, known, host=F.col("host"), path=F.col("path"))
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1000].site_prior < 0.5 < got[1001].site_prior
    assert got[1000].site_prior < got[1002].site_prior
    assert got[1003].quality is not None and 0 < got[1003].quality < 1
    assert all(got[i].kept == bool(label) for i, label in labels)


def test_quality_without_labels_or_rows(spark):
    df = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.quality(df, none, host=F.col("source"), path=F.col("lang"), keep=["doc_id", "text", "p", "host"])
    assert out.columns[:4] == ["doc_id", "text", "p", "host"] and ids_of(out) == expected_ids()
    assert {r.evidence for r in out.select(out["evidence"]).collect()} == {0.0}
    assert quality.quality(df.limit(0), none, host=F.col("source"), path=F.col("lang")).count() == 0
