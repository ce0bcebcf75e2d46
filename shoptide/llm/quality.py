"""Document quality by hierarchical empirical Bayes: a classifier's evidence on the text, and what is known of the
host and path that the document lies under, sparse sites being drawn towards the level above."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# At most so many labelled documents are used to fit the classifier.
SAMPLE = 20_000
# Bytes of each kind whose shares of a text are features, and the kind of all bytes over 127.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\v\f\r", "line": b"\n",
    "stop": b".,;:?'\"-()", "loud": b"!", "bar": b"|_=<>[]{}/\\~^`", "mark": b"@#$%&*+"}
_KIND = np.zeros(256, np.int64)
for _i, _bytes in enumerate(KINDS.values()):
    _KIND[list(_bytes)] = _i + 1
_KIND[128:] = len(KINDS) + 1
WIDTH = len(KINDS) + 4
# A text of so many bytes speaks half as loud as a long one: shares of short texts are chance.
HALF = 150


def _features(column: pa.Array) -> np.ndarray:
    """(row, WIDTH): shares of the kinds of bytes, words per byte, repeated words, how much the text's length says."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    out = np.zeros((len(column), WIDTH))
    for i, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if hi == lo:
            continue
        data = np.frombuffer(column.buffers()[2], np.uint8, hi - lo, lo)
        out[i, : len(KINDS) + 1] = np.bincount(_KIND[data], minlength=len(KINDS) + 2)[1:] / (hi - lo)
        words = data.tobytes().split()
        out[i, -3:] = len(words) / (hi - lo), 1 - len(set(words)) / max(len(words), 1), (hi - lo) / (hi - lo + HALF)
    return out


@dataclass
class Classifier:
    """Logistic regression on standardised features; ``evidence`` is its log-odds less those of its sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return np.clip(_design(x, self.mean, self.scale) @ self.weights - self.offset, -30, 30)


def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(x)), (x[:, :-1] - mean) / scale * x[:, -1:]))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Classifier:
    """Newton steps of ridge logistic regression. Without examples of both kinds there is no evidence at all."""
    if len(y) == 0 or y.min() == y.max():
        return Classifier(np.zeros(WIDTH - 1), np.ones(WIDTH - 1), np.zeros(WIDTH), 0.0)
    mean, scale = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-9
    z = _design(x, mean, scale)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6), z.T @ (p - y) + penalty * w)
    return Classifier(mean, scale, w, float(np.log(y.mean() / (1 - y.mean()))))


def _rows(docs: DataFrame, id_col: str, text_col: str, host: Column, path: Column, keep) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.struct(*keep or [F.lit(0)]).alias("_keep"))


def _mapped(rows: DataFrame, function, name: str, kind: T.DataType) -> DataFrame:
    """``function`` of the features of each row, beside the row's columns without the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), *batch.columns[2:], function(_features(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(columns, [*schema.names])

    schema = T.StructType([f for f in rows.schema if f.name != "_text"] + [T.StructField(name, kind)])
    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Classifier:
    """The classifier from at most ``sample`` labelled documents, those with the smallest hashes of their ids. Null
    ids, null labels and documents without a label are left out; of labels that repeat an id the largest counts."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("double").alias("y"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = _rows(docs, id_col, text_col, F.lit(""), F.lit(""), None)
    found = _mapped(rows, lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH).cast(pa.list_(pa.float64())), "x", T.ArrayType(T.DoubleType()))
    pairs = found.select("_id", "x").join(picked, "_id").orderBy("_id", "x").select("x", "y").limit(sample).collect()
    return fit(np.array([r.x for r in pairs]).reshape(-1, WIDTH), np.array([r.y for r in pairs]))


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, parent: str) -> Column | float:
    """How many documents the level above is worth: Beta prior strength by the method of moments, from groups
    (n, s, parent mean). Spread between groups that is no more than chance gives the strongest prior allowed."""
    mean, above = F.col("s") / F.col("n"), F.col(parent)
    got = groups.filter("n > 1").agg(
        F.sum(F.col("n") * (mean - above) ** 2).alias("spread"), F.sum(above * (1 - above)).alias("chance"), F.sum(F.col("n") * above * (1 - above)).alias("all"), F.count("*").alias("k")).first()
    if not got.k:
        return 10.0
    # E[n (mean - above)^2] = above (1 - above) (1 + (n - 1) rho), with strength = 1 / rho - 1.
    rho = (got.spread - got.chance) / max(got["all"] - got.chance, 1e-12)
    rho = min(max(rho, 1e-3), 0.999)
    return 1 / rho - 1


def quality(docs: DataFrame, labels: DataFrame, *, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            threshold: float = 0.5, sample: int = SAMPLE, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(id, evidence, site_prior, quality, kept) of every row; with ``keep``, those columns of ``docs`` follow.

    ``evidence`` is the classifier's log-likelihood ratio for the whole text. Every document adds its
    probability by evidence alone to its path, its host and the corpus; a path's mean is drawn towards its host's
    and that towards the corpus mean, by strengths estimated from all groups. ``site_prior`` is the path's
    posterior mean without the document itself, and ``quality`` combines it with the evidence. ``kept``:
    quality >= ``threshold``.

    A null text is an empty one, a null host or path an unnamed one. Repeated rows each count and each give a
    row. Without labels of both kinds the evidence is 0 and every document gets the prior 0.5. An empty table
    gives an empty table.
    """
    classifier = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample=sample)
    rows = _rows(docs, id_col, text_col, host, path, keep)
    scored = _mapped(rows, lambda x: pa.array(classifier.evidence(x)), "evidence", T.DoubleType())
    base = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(classifier.offset))))
    scored = scored.withColumn("p", base)

    from shoptide.llm.common import written

    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "site-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = total.s / total.n if total.n else 0.5
    over_hosts = float(_strength(hosts.withColumn("above", F.lit(mean)), "above"))
    host_mean = (F.col("s") + over_hosts * mean) / (F.col("n") + over_hosts)
    sites = paths.join(hosts.select("host", host_mean.alias("host_mean")), "host")
    over_paths = float(_strength(sites, "host_mean"))
    sites = sites.select("host", "path", F.col("n").alias("site_n"), F.col("s").alias("site_s"), "host_mean")

    prior = (F.col("site_s") - F.col("p") + over_paths * F.col("host_mean")) / (F.col("site_n") - 1 + over_paths)
    out = scored.join(sites, ["host", "path"]).withColumn("site_prior", F.least(F.greatest(prior, F.lit(0.0)), F.lit(1.0)))
    out = out.withColumn("quality", 1 / (1 + F.exp(-(F.col("evidence") + _odds(F.col("site_prior"))))))
    results = ["evidence", "site_prior", "quality", (F.col("quality") >= threshold).alias("kept")]
    if keep:
        return out.select("_keep.*", *[F.col(c) if isinstance(c, str) else c for c in results])
    return out.select(F.col("_id").alias(id_col), *results)
