from __future__ import annotations

import hashlib
import html
import re

import duckdb
import pytest
from pyspark.errors import PySparkException

from shoptide.llm import html_extract, warc
from shoptide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def archive_rows(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, payload string")
    return {r.page_id: r for r in warc.read_archive(spark, warc.write_archive(df)).collect()}


def test_records_come_back_whole(spark):
    big = "<p>é same</p>" * 20
    rows = [(3, "http://a/\r\nX: y", big), (1, "http://b/", big), (2, None, "short"), (4, "http://c/", "short"), (5, "http://d/", None), (6, "http://e/", ""), (None, "http://f/", big)]
    got = archive_rows(spark, [(*r, "x", "y") for r in rows])
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), 2: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None), None: ("revisit", 1)}
    for key, _, text in rows:
        body = (text or "").encode()
        r = got[key]
        assert bytes(r.payload) == body and r.payload_digest == hashlib.sha256(body).hexdigest() and r.payload_bytes == len(body)
        assert bytes(r.record) == r.header.encode() + body + b"\r\n\r\n"
        assert r.header.startswith("WARC/1.1\r\n") and r.header.endswith("\r\n\r\n") and r.header.count("\r\n\r\n") == 1
        assert f"Content-Length: {len(body)}\r\n" in r.header
    assert "http://a/%0D%0AX: y" in got[3].header


def test_payloads_are_stored_once_and_checked(spark):
    df = spark.createDataFrame([(i, "u", "same payload " * 20) for i in range(50)] + [(99, "u", "other")], "page_id long, url string, html string")
    archive = warc.write_archive(df)
    assert spark.read.parquet(archive.payloads).count() == 2
    spark.read.parquet(archive.payloads).limit(0).write.parquet(archive.payloads + "-lost")
    with pytest.raises(PySparkException, match="does not have digest"):
        warc.read_archive(spark, warc.Archive(archive.headers, archive.payloads + "-lost")).collect()


def test_empty_archive(spark):
    assert archive_rows(spark, []) == {}


def test_warc_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    df = QUERIES["op2_warc"](spark, SF)
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(map(repr, con.execute(ORACLES["op2_warc"]).fetchall()))


def article(page):
    """The article of the tables' pages, whose mark-up says where it is."""
    found = re.search(r"(?s)<article>(.*?)</article>", page)
    if not found:
        return None
    text = re.sub(r"<br>|</?p>|</?h1>", " ", found[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


@pytest.fixture(scope="module")
def labeller(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).collect()]
    return html_extract.fit(pages, rounds=24)


def test_main_text_of_pages_not_trained_on(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").filter("page_id >= 120")
    got = {r.page_id: r for r in html_extract.extract(pages, labeller).collect()}
    want = {r.page_id: article(r.html) for r in pages.collect()}
    right = sum(got[k].text == t for k, t in want.items() if t is not None)
    assert right >= 0.98 * len(want)
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_other_templates(labeller):
    page = """<html><head><title>t</title></head><body><header><a href="/">Home</a></header><div class="cookie-notice">We use cookies</div><main><h1>Big
      title</h1><p>First&nbsp;para of the <b>st</b>ory &amp; more text here.</p><div class="comments"><p>Great post</p></div><p>Second para of the story.</p></main>
      <aside class="sidebar"><p>Trending now</p></aside><form><label>Email</label><button>Go</button></form><script>var a = "<p>no</p>"</script><footer>c</footer></body></html>"""
    found = html_extract.blocks(page)
    chosen = labeller.label([html_extract.features(found)])[0]
    assert [b.text for b, yes in zip(found, chosen, strict=True) if yes] == ["Big title", "First para of the story & more text here.", "Second para of the story."]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><body><article><p>Body text</p></article>", ["Body text"]),
        ("<head><title>a <b> <script></title><meta charset=x><style>p {}</style><p>first", ["first"]),
        ("<head><title>t</title>plain <b>text</b>", ["plain text"]),
        ("<head><title>t</title></head><body>b", ["b"]),
        *[(f"<p>a</p><{tag}><p>b</p><p>c", ["a", "b", "c"]) for tag in sorted(html_extract.HIDDEN_TAGS)],
        *[(f"<p>a</p><{tag}><p>b</p><{tag}>no</{tag}><p>c", ["a", "b", "c"]) for tag in sorted(html_extract.HIDDEN_TAGS)],
        *[(f"<p>a</p><{tag}><p>b</p></{tag}><p>c", ["a", "c"]) for tag in sorted(html_extract.HIDDEN_TAGS)],
        *[(f"<p>a</p><{tag}><p>b</p>", ["a"]) for tag in sorted(html_extract.RAW)],
        ("<p title=it's>one</p><p>it's two</p>", ["one", "it's two"]),
        ("<p title='a > b'>one<p data-x=\"it's\" title = 'y>'>two", ["one", "two"]),
    ])
def test_tags_without_end_hide_nothing(page, want):
    assert [b.text for b in html_extract.blocks(page)] == want


def test_gradients_are_right():
    import numpy as np

    rng = np.random.default_rng(0)
    model = html_extract.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = html_extract._padded([rng.normal(size=(n, html_extract.INPUT)) for n in (5, 3)])
    x, y = x.astype(np.float64), (rng.random(mask.shape) < 0.5).astype(float)
    _, grad = model.step(x, mask, y)
    for name in model.p:
        flat, at = model.p[name].reshape(-1), rng.integers(0, model.p[name].size)
        flat[at] += 1e-5
        up = model.step(x, mask, y)[0]
        flat[at] -= 2e-5
        down = model.step(x, mask, y)[0]
        flat[at] += 1e-5
        assert abs((up - down) / 2e-5 - grad[name].reshape(-1)[at]) < 1e-3, name


def test_odd_pages(spark, labeller):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text &lt;b&gt;"), (4, "u", "<p>open <b>never closed"), (5, "u", "<script>only"), (5, "u", "<script>only"), (None, "u", "<!-- x"), (7, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, _html string")
    out = html_extract.extract(df, labeller)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert [b.text for b in html_extract.blocks("<p>a&amp;b\n c<br>d<p>e")] == ["a&b c", "d", "e"]
    assert html_extract.extract(df.limit(0), labeller).count() == 0
    assert html_extract.train(df.limit(0)).label([]) == []
