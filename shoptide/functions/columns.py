"""Column expressions shared by batch and streaming plans. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MS_PER_YEAR = 365 * 24 * 60 * 60 * 1000

# One Han or Hiragana character is a token of its own; other letters and digits run together.
TOKEN_PATTERN = r"[\p{IsHan}\p{IsHiragana}]|[\p{L}\p{M}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]]+"


def epoch_ms(ts: str | Column) -> Column:
    """Epoch milliseconds as a timestamp; a missing value counts as 0."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_millis(F.coalesce(col, F.lit(0)))


def with_log_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``log_date`` and ``log_hour`` (session time zone) from epoch milliseconds."""
    at = epoch_ms(ts)
    return df.withColumns(
        {"log_date": F.date_format(at, "yyyy-MM-dd"), "log_hour": F.date_format(at, "HH")}
    )


def with_order_time(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add ``create_date`` and ``create_hour`` by splitting ``yyyy-MM-dd HH:mm:ss``."""
    text = F.col(create_time)
    clock = F.split_part(text, F.lit(" "), F.lit(2))
    return df.withColumns(
        {
            "create_date": F.nullif(F.split_part(text, F.lit(" "), F.lit(1)), F.lit("")),
            "create_hour": F.nullif(F.split_part(clock, F.lit(":"), F.lit(1)), F.lit("")),
        }
    )


def mask_phone(tel: str | Column) -> Column:
    """Replace characters 4 to 7 of a phone number by four stars."""
    col = F.col(tel) if isinstance(tel, str) else tel
    return F.concat(F.substring(col, 1, 3), F.lit("****"), F.substr(col, F.lit(8)))


def doc_id(sep: str, *parts: str | Column) -> Column:
    """Composite document key. Grouping uses the columns; the text is for sinks only."""
    return F.concat_ws(sep, *parts)


def minute_of(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm")


def age_at(birthday: str | Column, as_of: str | Column) -> Column:
    """Whole 365-day years between ``birthday`` and ``as_of``, cut towards zero.

    ``as_of`` is a literal such as ``'2024-01-01'`` or a timestamp column. A birthday that is
    no date gives null.
    """
    born = F.col(birthday) if isinstance(birthday, str) else birthday
    now = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of.cast("timestamp")
    born_at = born.try_cast("date").cast("timestamp")
    elapsed = F.unix_millis(now) - F.unix_millis(born_at)
    return F.call_function("div", elapsed, F.lit(MS_PER_YEAR).cast("bigint")).cast("int")


def money(amount: str | Column) -> Column:
    """Amount in cents, rounded."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return col.cast("decimal(18,2)")


def money_sum(amount: str | Column) -> Column:
    """Sum of amounts, rounded to cents once at the end.

    Amounts are summed as decimals, so the result does not depend on the order of the rows; one too large
    for that makes the sum a plain sum of doubles.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    exact = F.sum(col.try_cast("decimal(28,10)"))
    whole = F.count(col) == F.count(col.try_cast("decimal(28,10)"))
    return F.when(whole, F.round(exact, 2).cast("double")).otherwise(F.round(F.sum(col.cast("double")), 2))


def percent(part: Column, total: Column) -> Column:
    """Share in percent, rounded half up to one decimal; 0 when there is no total."""
    rounded = F.floor(part * F.lit(1000.0) / F.nullif(total, F.lit(0)) + F.lit(0.5)) / F.lit(10.0)
    return F.coalesce(rounded, F.lit(0.0))


def tokens(text: str | Column) -> Column:
    """Lower-case word tokens of a text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), F.lit(0))
