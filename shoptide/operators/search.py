"""Search over sale rows: keyword match, token index, relevance, value counts, paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions import tokens
from shoptide.operators.keyed import near_keys

# The usual constants of BM25, how soon more of the same token and how much a text's length count.
SATURATION, LENGTH_SHARE = 1.2, 0.75
# Pages up to this row are taken from the best rows of every task; deeper ones by counting.
DEEP = 10_000
BOUNDS = 64


def match_all(text: str | Column, keyword: str) -> Column:
    """Every token of ``keyword`` occurs in the text, in any order; no tokens match nothing."""
    wanted = tokens(F.lit(keyword))
    found = F.size(F.array_except(wanted, tokens(text))) == 0
    return (F.size(wanted) > 0) & F.coalesce(found, F.lit(False))


def search(sales: DataFrame, date: str, keyword: str) -> DataFrame:
    """Sale rows of a day whose product name matches. The day filter prunes partitions."""
    return sales.filter((F.col("dt") == date) & match_all("sku_name", keyword))


def keyword_tokens(df: DataFrame, keyword: str) -> list[str]:
    """The distinct tokens of a keyword, split as texts are."""
    return sorted(set(df.sparkSession.range(1).select(tokens(F.lit(keyword)).alias("t")).first().t))


def token_rows(rows: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """(keep, token, key): the inverted form of a text column, a row per distinct token."""
    return rows.select(*keep, F.explode(F.array_distinct(tokens(text))).alias("token"), key)


def keys_of_tokens(index: DataFrame, keyword: str, key: str) -> DataFrame:
    """(key) of the rows of a token index (token, key) that hold every token of the keyword; no tokens match nothing.

    Only rows of the keyword's tokens are read; a key matches when it has as many of them as there are.
    """
    wanted = keyword_tokens(index, keyword)
    hits = index.filter(F.col("token").isin(wanted) if wanted else F.lit(False))
    if len(wanted) == 1:
        return hits.select(key).distinct()
    return hits.groupBy(key).agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(wanted)).select(key)


def with_relevance(searched: DataFrame, text: str, keyword: str, name: str = "score") -> DataFrame:
    """Rows whose ``text`` holds every token of the keyword, with their BM25 score, rounded to six places.

    How rare a token is, and how long texts are, is counted over all of ``searched`` in one pass that ends in one row.
    """
    wanted = keyword_tokens(searched, keyword)
    found = tokens(text)
    counts = [F.count(F.when(F.array_contains(found, w), 1)).alias(f"df{k}") for k, w in enumerate(wanted)]
    total = searched.filter(F.col(text).isNotNull()).agg(F.count("*").alias("n"), F.avg(F.size(found)).alias("length"), *counts).first()
    hits = searched.filter(match_all(text, keyword)).withColumn("_tokens", found)
    size = F.size("_tokens") / F.lit(total.length or 1.0)
    score = F.lit(0.0)
    for k, word in enumerate(wanted):
        rarity = F.log(F.lit(1.0) + (F.lit(total.n) - total[f"df{k}"] + 0.5) / F.lit(total[f"df{k}"] + 0.5))
        times = F.size("_tokens") - F.size(F.array_remove("_tokens", word))
        score = score + rarity * times * (SATURATION + 1) / (times + SATURATION * (1 - LENGTH_SHARE + LENGTH_SHARE * size))
    return hits.withColumn(name, F.round(score, 6)).drop("_tokens")


def terms(df: DataFrame, column: str, size: int, weight: str | None = None) -> DataFrame:
    """(column, n): the ``size`` most frequent values, ties in value order. Nulls do not count. With ``weight``, a row
    stands for so many."""
    n = F.sum(weight) if weight else F.count("*")
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(n.alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(size)


def page(df: DataFrame, number: int, size: int, order: list[str], deep: int = DEEP) -> DataFrame:
    """Page ``number`` (from 1) of the rows in a fixed order of columns; ``-column`` for a descending number.

    A page far behind would bring all rows before it into one task. Instead rows are counted between bounds taken from them,
    the stretch that holds the page is counted again between finer ones, and only rows of a stretch of at
    most ``deep`` rows, or of one value, are sorted. ``df`` is read several times then.
    """
    keys = [-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in order]
    skip = (number - 1) * size
    if skip + size > deep:
        df, skip = stretch_of(df, keys, skip, size, deep)
    return df.orderBy(*keys).offset(skip).limit(size)


def stretch_of(df: DataFrame, keys: list[Column], skip: int, size: int, deep: int = DEEP) -> tuple[DataFrame, int]:
    """A stretch of ``df`` in the order of ``keys`` that holds the rows ``skip`` to ``skip + size``, and how many of its own rows
    come before them."""
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    while True:
        # A bounded random sample: each task sends BOUNDS rows at most.
        sample = df.select(key.alias("key")).orderBy(F.rand(7)).limit(BOUNDS)
        bounds = [r.key for r in sample.distinct().orderBy("key").collect()]
        if not bounds:
            return df, skip
        literals = [_literal(b, df.select(key.alias("key")).schema["key"].dataType) for b in bounds]
        # How many of the bounds are not above a row's key: the number of its stretch.
        place = reduce(lambda a, b: a + b, [(key >= b).cast("int") for b in literals])
        counts = dict(df.groupBy(place.alias("place")).count().collect())
        seen, first = 0, 0
        while seen + counts.get(first, 0) <= skip and first < len(bounds):
            seen += counts.get(first, 0)
            first += 1
        last, held = first, counts.get(first, 0)
        while seen + held < skip + size and last < len(bounds):
            last += 1
            held += counts.get(last, 0)
        within = sum(counts.values())
        inside = F.lit(True)
        if first > 0:
            inside = inside & (key >= literals[first - 1])
        if last < len(bounds):
            inside = inside & (key < literals[last])
        df, skip = df.filter(inside), skip - seen
        if held <= max(deep, 2 * size) or held == within:
            return df, skip


def _literal(row, kind) -> Column:
    """A row of keys as a literal structure."""
    return F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, kind.fields, strict=True)])


def only_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows with one of the listed keys; others are left out before they are shuffled."""
    return near_keys(rows, keys, [key]).join(keys, key, "left_semi")
