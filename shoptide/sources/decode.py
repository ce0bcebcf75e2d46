"""JSON message → typed row. Rows that do not decode are set aside, not lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed"
RAW = "raw"


def decode(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: tuple[str, ...] = (),
    patterns: dict[str, str] | None = None,
) -> DataFrame:
    """Columns of ``schema`` by field name, then ``malformed`` and ``raw``.

    Every field is first read as text, because change feeds send numbers in quotes and logs send
    ids as bare numbers; it is then cast to its type. A message that is no JSON object, or has a
    value its type cannot hold, has ``malformed`` set, null fields and its text in ``raw``; so has
    one with a field that does not match its pattern. ``keep`` passes columns of ``df`` through.
    """
    corrupt = "_corrupt"
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    text = F.col(value).cast("string")
    # A missing or blank message parses to nulls without being reported as corrupt.
    empty = text.isNull() | (F.trim(text) == "")
    parsed = df.select(*keep, text.alias(RAW), F.from_json(text, as_text, options).alias("p"), empty.alias("empty"))

    bad = F.col("empty") | F.col("p").isNull() | F.col(f"p.{corrupt}").isNotNull()
    typed = {}
    for field in schema:
        source = F.col(f"p.{field.name}")
        if isinstance(field.dataType, T.StringType):
            typed[field.name] = source
        else:
            typed[field.name] = source.try_cast(field.dataType)
            bad = bad | (source.isNotNull() & typed[field.name].isNull())
    for name, pattern in (patterns or {}).items():
        bad = bad | ~F.coalesce(F.col(f"p.{name}").rlike(pattern), F.lit(False))
    checked = parsed.select(*keep, RAW, bad.alias(MALFORMED), *[c.alias(n) for n, c in typed.items()])
    good = ~F.col(MALFORMED)
    return checked.select(
        *keep,
        *[F.when(good, F.col(name)).alias(name) for name in typed],
        MALFORMED,
        F.when(F.col(MALFORMED), F.col(RAW)).alias(RAW),
    )


def decoded(df: DataFrame) -> DataFrame:
    """The rows that decoded."""
    return df.filter(~F.col(MALFORMED)).drop(MALFORMED, RAW)


def quarantine(df: DataFrame) -> DataFrame:
    """The raw messages that did not."""
    return df.filter(F.col(MALFORMED)).select(RAW)


def nested(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Columns of a schema that is not flat; messages that do not parse are left out, see :func:`unparsed`."""
    parsed = df.select(_nested(schema, value).alias("p"))
    return parsed.filter(F.col("p").isNotNull()).select("p.*")


def unparsed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """(raw): the messages that :func:`nested` leaves out."""
    return df.filter(_nested(schema, value).isNull()).select(F.col(value).cast("string").alias(RAW))


def _nested(schema: T.StructType, value: str) -> Column:
    """The parsed message; null where it is no JSON object or a field does not have its type."""
    corrupt = "_corrupt"
    parsed = F.from_json(F.col(value).cast("string"), T.StructType([*schema, T.StructField(corrupt, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    fields = F.struct(*[parsed[f.name].alias(f.name) for f in schema])
    return F.when(F.col(value).isNotNull() & (F.trim(F.col(value).cast("string")) != "") & parsed[corrupt].isNull(), fields)
