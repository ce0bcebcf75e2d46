"""Totals, hourly curves and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoptide.functions import money_sum, percent, with_log_time
from shoptide.sources.tables import on_dates


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """One row (value): devices active on ``date``. ``dau`` has one row per device and day."""
    return on_dates(dau, "log_date", date).agg(F.count("*").alias("value"))


def dau_hours(dau: DataFrame, *dates: str) -> DataFrame:
    """(log_date, hour, value): devices by the hour of their first log."""
    return on_dates(dau, "log_date", *dates).groupBy("log_date", F.col("log_hour").alias("hour")).agg(F.count("*").alias("value"))


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """One row (value): order amount of ``date``, null when there is no order."""
    return on_dates(orders, "create_date", date).agg(money_sum("total_amount").alias("value"))


def gmv_hours(orders: DataFrame, *dates: str) -> DataFrame:
    """(create_date, hour, value): order amount by hour."""
    return (
        on_dates(orders, "create_date", *dates)
        .groupBy("create_date", F.col("create_hour").alias("hour"))
        .agg(money_sum("total_amount").alias("value"))
    )


def hour_change(orders: DataFrame, sign: int) -> DataFrame:
    """(create_date, hour, amount, orders) that stored orders add to their hours, or take from them. An amount that is missing, or of
    10^18 or more, counts as 0."""
    amount = F.coalesce(F.col("TOTAL_AMOUNT").try_cast("decimal(28,10)"), F.lit(0)) * sign
    hour = F.col("CREATE_HOUR").alias("hour")
    return orders.select(F.col("CREATE_DATE").alias("create_date"), hour, amount.cast("decimal(28,10)").alias("amount"), F.lit(sign).cast("bigint").alias("orders"))


def changed_hours(stood: DataFrame, change: DataFrame) -> DataFrame:
    """The hours that ``change`` touches with their new totals."""
    touched = change.groupBy("create_date", "hour").agg(F.sum("amount").alias("more"), F.sum("orders").alias("n")).filter("more <> 0 OR n <> 0")
    joined = touched.join(stood, ["create_date", "hour"], "left")
    amount = (F.coalesce("amount", F.lit(0)) + F.col("more")).cast("decimal(38,10)")
    return joined.select("create_date", "hour", amount.alias("amount"), (F.coalesce("orders", F.lit(0)) + F.col("n")).alias("orders"))


def kept_hours(hours: DataFrame, *dates: str) -> DataFrame:
    """(create_date, hour, value) from totals that are kept by hour; hours whose orders have all moved away are left out."""
    return on_dates(hours, "create_date", *dates).filter("orders > 0").select("create_date", "hour", F.round("amount", 2).cast("double").alias("value"))


def fill_hours(spark: SparkSession, hourly: DataFrame, date_col: str, *dates: str) -> DataFrame:
    """All 24 hours of each date, hours without a row having value 0."""
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.lpad(h.cast("string"), 2, "0"))
    days = F.explode(F.array(*[F.lit(d) for d in dates]))
    spine = spark.range(1).select(days.alias(date_col)).select(date_col, F.explode(hours).alias("hour"))
    zero = F.lit(0).cast(hourly.schema["value"].dataType)
    return spine.join(hourly, [date_col, "hour"], "left").select(date_col, "hour", F.coalesce("value", zero).alias("value"))


def first_seen(logs: DataFrame) -> DataFrame:
    """(mid, ts, log_date, log_hour) of the first log ever of each device."""
    return with_log_time(logs.groupBy("mid").agg(F.min("ts").alias("ts")))


def new_mid_total(first: DataFrame, date: str) -> DataFrame:
    """One row (value): devices never seen before ``date``. ``first`` has the first log ever of each device, see
    :func:`first_seen`; the one that is kept by day is read of that day only."""
    return dau_total(first, date)


def new_mid_hours(first: DataFrame, *dates: str) -> DataFrame:
    """(log_date, hour, value): new devices by hour."""
    return dau_hours(first, *dates)


def sales_by_province(orders: DataFrame) -> DataFrame:
    """(province_id, orders, amount)."""
    return orders.groupBy("province_id").agg(
        F.count("*").alias("orders"), money_sum("total_amount").alias("amount")
    )


def share_counts(sales: DataFrame, weight: str | None = None) -> DataFrame:
    """One row with every count the gender and age shares need. With ``weight``, a row stands for so many sales.

    An unknown user has age 0 and so counts as under 20. The total counts every row, whatever
    its gender.
    """
    age, gender, each = F.col("user_age"), F.col("user_gender"), F.col(weight) if weight else F.lit(1)

    def count_if(test):
        return F.coalesce(F.sum(F.when(test, each)), F.lit(0)).cast("bigint")

    return sales.agg(
        count_if(F.lit(True)).alias("total"),
        count_if(gender == "M").alias("male"),
        count_if(gender == "F").alias("female"),
        count_if(age < 20).alias("under_20"),
        count_if((age >= 20) & (age < 30)).alias("from_20"),
        count_if(age >= 30).alias("from_30"),
    )


# The labels of the report.
GENDER_TITLE = "性别占比"
AGE_TITLE = "年龄占比"
GENDER_OPTIONS = {"male": "男", "female": "女"}
AGE_OPTIONS = {"under_20": "20岁以下", "from_20": "20岁到30岁", "from_30": "30岁以上"}


def _shares(counts: DataFrame, options: dict[str, str]) -> DataFrame:
    rows = [F.struct(F.lit(label).alias("name"), percent(F.col(c), F.col("total")).alias("value")) for c, label in options.items()]
    return counts.select(F.inline(F.array(*rows)))


def gender_share(sales: DataFrame, weight: str | None = None) -> DataFrame:
    """(name, value): percent of rows with male and with female users."""
    return _shares(share_counts(sales, weight), GENDER_OPTIONS)


def age_share(sales: DataFrame, weight: str | None = None) -> DataFrame:
    """(name, value): percent of rows by the age bands under 20, 20 to 29, 30 and over."""
    return _shares(share_counts(sales, weight), AGE_OPTIONS)


def observed_sum(df: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    """``df`` with ``column`` doubled, and an observation of the sum before doubling.

    The observation holds the sum of the first action on the result; later actions do not add.
    """
    seen = Observation("observed_sum")
    watched = df.observe(seen, money_sum(column).alias("total"))
    return watched.withColumn(column, F.col(column) * 2), seen
