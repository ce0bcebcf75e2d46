"""The registered queries of the operators, and SQL that they must equal where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import (
    embedding_lsh,
    exact_dedup,
    html_extract,
    importance,
    jaccard_join,
    language_id,
    manifest,
    packing,
    piece_lattice,
    quality,
    token_counts,
    topk_search,
    warc,
)
from shoptide.llm.common import table


def held_out(doc_id="doc_id"):
    """Documents that no language model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~held_out()))
    return language_id.predict(docs, model).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality(docs, labels, host=F.col("source"), path=F.concat_ws("/", "source", "lang"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_lattice.summary(docs, piece_lattice.load(spark, public_tokenizers.path("piece_bpe_32k.model")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.near_dedup(table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_warc": op2_warc,
    "op3_language_id": op3_language_id,
    "op4_html_extract": op4_html_extract,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_piece_lattice": op9_piece_lattice,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_importance": op11_importance,
    "op12_topk_search": op12_topk_search,
    "op13_manifest": op13_manifest,
}

# CRC-32 by its table, which DuckDB has no function for: ``tab`` and the CRC of a list of bytes.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab"""
_CRC = "xor(list_reduce({0}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f) for f in ["doc_id", "source", "lang", "n_chars", text]) + ")"

ORACLES: dict[str, str] = {
    "op2_warc": r"""
        WITH p AS (
            SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM p JOIN f USING (payload_digest)""",
    "op7_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)""",
    "op8_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
            FROM w),
        g AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS g FROM s),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT s.doc_id, len(shingles) AS n_shingles, least(s.doc_id, coalesce(min(reach.b), s.doc_id)) AS component_id
        FROM s LEFT JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, shingles""",
    "op11_importance": r"""
        WITH crc AS (""" + _CRC_TABLE + r"""),
        d AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
            FROM benchmark),
        f AS (SELECT side, id, unnest(w) AS w FROM d),
        h AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM f)),
        l AS (SELECT w, list_transform(range(0, strlen(w)), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS bytes FROM h),
        b AS (SELECT w, """ + _CRC.format("bytes") + r""" % 10000 AS bucket FROM l, crc),
        c AS (SELECT bucket, CAST(count(*) FILTER (side = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (side = 'b') AS DOUBLE) AS t FROM f JOIN b USING (w) GROUP BY bucket),
        n AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM c),
        g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM c, n),
        m AS (SELECT id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (w) JOIN g USING (bucket) WHERE side = 'd' GROUP BY id),
        s AS (
            SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                   CAST('0x' || substr(sha256('2024:' || d.id), 1, 8) AS BIGINT) AS h
            FROM d LEFT JOIN m ON m.id = d.id WHERE side = 'd'),
        e AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM s),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM e WHERE n_features >= 20)
        SELECT e.doc_id, n_features, weight, score, r.rank
        FROM e LEFT JOIN r ON r.doc_id = e.doc_id AND r.rank <= (10 * r.n) // 100""",
    "op12_topk_search": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
            FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_manifest": r"""
        WITH RECURSIVE crc AS (""" + _CRC_TABLE + r"""),
        d AS (
            SELECT doc_id, source, """ + _leaf_sql("text") + r""" AS leaf, """ + _leaf_sql("replace(text, chr(10), '')") + r""" AS other,
                   list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT)) AS digits,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
            FROM documents),
        low AS (
            SELECT source, 0 AS lvl, list(leaf ORDER BY doc_id) AS nodes FROM d GROUP BY source
            UNION ALL
            SELECT source, lvl + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
            FROM low WHERE len(nodes) > 1),
        subs AS (SELECT source, lvl AS depth, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM low WHERE len(nodes) = 1),
        high AS (
            SELECT 0 AS lvl, list(subroot ORDER BY place) AS nodes FROM subs
            UNION ALL
            SELECT lvl + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
            FROM high WHERE len(nodes) > 1),
        steps AS (
            SELECT doc_id, low.lvl AS lvl, nodes, CAST(floor(pos / pow(3, low.lvl)) AS BIGINT) AS node
            FROM d JOIN low ON low.source IS NOT DISTINCT FROM d.source AND len(nodes) > 1
            UNION ALL
            SELECT doc_id, 1000 + high.lvl, nodes, CAST(floor(place / pow(3, high.lvl)) AS BIGINT)
            FROM d JOIN subs ON subs.source IS NOT DISTINCT FROM d.source JOIN high ON len(nodes) > 1),
        runs AS (SELECT doc_id, lvl, node % 3 AS slot, nodes[3 * (node // 3) + 1 : 3 * (node // 3) + 3] AS run FROM steps),
        paths AS (
            SELECT doc_id, list(array_to_string(run[1 : slot], '') || '|' || array_to_string(run[slot + 2 : 3], '') ORDER BY lvl) AS path
            FROM runs GROUP BY doc_id),
        f AS (
            SELECT d.doc_id, leaf, subroot, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root, coalesce(path, []) AS path,
                   CASE WHEN """ + _CRC.format("digits") + r""" % 2 = 0 THEN other ELSE leaf END AS start
            FROM crc, d JOIN subs ON subs.source IS NOT DISTINCT FROM d.source LEFT JOIN paths ON paths.doc_id = d.doc_id),
        g AS (SELECT *, list_reduce(path, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), start) AS folded_root FROM f)
        SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM g""",
}
