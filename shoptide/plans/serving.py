"""The reports as JSON, read from the tables the jobs keep.

    python -m shoptide.plans.serving total --date 2024-01-15 --dau /tables/dau --first /tables/first --orders /tables/orders
    python -m shoptide.plans.serving hours --id dau --date 2024-01-15 --dau ... --orders ...
    python -m shoptide.plans.serving alerts --date 2024-01-15 --docs /tables/alerts --out /reports/alerts
    python -m shoptide.plans.serving sales --date 2024-01-15 --keyword red --page 1 --size 20 --sales /tables/sales

The reports come as one JSON text each; they are small by nature: three totals, at most 48 hours,
one page. Alerts come as JSON lines, a file per partition, in the folder ``--out``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.operators import alerts, metrics
from shoptide.plans import reports
from shoptide.session import build_session
from shoptide.sources.tables import on_dates
from shoptide.streaming import jobs


def _only(test: Column, value: Column) -> Column:
    return F.max(F.when(test, value))


def total_json(report: DataFrame) -> DataFrame:
    """``[{"id": "dau", "name": ..., "value": ...}, ...]``"""
    entries = [
        F.struct(F.lit(key).alias("id"), F.lit(name).alias("name"), _only(F.col("id") == key, F.col("value")).alias("value"))
        for key, name in reports.TOTALS.items()
    ]
    return report.agg(F.to_json(F.array(*entries), {"ignoreNullFields": "false"}).alias("json"))


def hours_json(report: DataFrame) -> DataFrame:
    """``{"yesterday": {"09": 1.0, ...}, "today": {...}}``; null for the days of a metric that does not exist."""

    def day(label: str) -> Column:
        entry = F.when((F.col("label") == label) & F.col("hour").isNotNull(), F.struct("hour", "value"))
        hours = F.map_from_entries(F.array_sort(F.collect_list(entry)))
        unknown = F.coalesce(F.bool_or((F.col("label") == label) & F.col("hour").isNull()), F.lit(False))
        return F.when(~unknown, hours).alias(label)

    return report.agg(F.to_json(F.struct(day("yesterday"), day("today")), {"ignoreNullFields": "false"}).alias("json"))


def sale_detail_json(report: DataFrame) -> DataFrame:
    """``{"total": ..., "stat": [{"title": ..., "options": [...]}, ...], "detail": [...]}``"""

    def stat(title: str, options: dict[str, str]) -> Column:
        shares = [
            F.struct(F.lit(label).alias("name"), _only((F.col("section") == "stat") & (F.col("name") == label), F.col("value")).alias("value"))
            for label in options.values()
        ]
        return F.struct(F.lit(title).alias("title"), F.array(*shares).alias("options"))

    stats = F.array(stat(metrics.AGE_TITLE, metrics.AGE_OPTIONS), stat(metrics.GENDER_TITLE, metrics.GENDER_OPTIONS))
    total = _only(F.col("section") == "total", F.col("value")).cast("bigint").cast("string")
    rows = F.array_sort(F.collect_list(F.when(F.col("section") == "detail", F.struct("name", "detail"))))
    details = F.array_join(F.transform(rows, lambda r: r["detail"]), ",")
    text = F.concat(F.lit('{"total":'), total, F.lit(',"stat":'), F.to_json(stats), F.lit(',"detail":['), details, F.lit("]}"))
    return report.agg(text.alias("json"))


def _stored_first(spark: SparkSession, dau: str, first: str, *dates: str) -> DataFrame:
    """First logs ever of devices: of the table that the job of new devices keeps by day, or, without one, of all device days."""
    if first:
        return jobs.standing(jobs.first_day_table(first).read(spark, folders=list(dates)))
    # A minimum needs no choice between versions of a row.
    return metrics.first_seen(jobs.dau_table(dau).versions(spark))


def stored_totals(spark: SparkSession, dau: str, orders: str, date: str, first: str = "") -> DataFrame:
    devices, sold = jobs.dau_table(dau).read(spark, folders=[date]), jobs.order_table(orders).read(spark, folders=[date])
    return reports.realtime_total(devices, _stored_first(spark, dau, first, date), sold, date)


def stored_hours(spark: SparkSession, dau: str, orders: str, metric: str, date: str, first: str = "", hours: str = "") -> DataFrame:
    days = [date, reports.day_before(date)]
    if metric == "order_amount" and hours:
        return reports.hours_of_days(metric, metrics.kept_hours(jobs.hour_table(hours).read(spark, folders=days), *days), "create_date", date)
    devices, sold = jobs.dau_table(dau).read(spark, folders=days), jobs.order_table(orders).read(spark, folders=days)
    return reports.realtime_hours(spark, metric, date, devices, _stored_first(spark, dau, first, *days), sold)


def stored_sales(spark: SparkSession, sales: str, date: str, keyword: str, page: int, size: int, index: str = "", by_relevance: bool = False) -> DataFrame:
    found = jobs.token_table(index).versions(spark, folders=[date]) if index else None
    return reports.sale_detail_report(jobs.sale_table(sales).read(spark, folders=[date]), date, keyword, page, size, index=found, by_relevance=by_relevance)


def stored_alerts(spark: SparkSession, panes: str, date: str, docs: str = "", **window: int) -> DataFrame:
    """Alerts of a day: the documents that the alerts job keeps in ``docs`` and that still stand, or, of a job that keeps none,
    decided from its panes. A day's first windows reach into the day before, so two days of panes are read."""
    if docs:
        return on_dates(jobs.standing(jobs.alert_table(docs).read(spark, folders=[date])), "dt", date)
    days = jobs.pane_table(panes).read(spark, folders=[date, reports.day_before(date)])
    return alerts.pane_alerts(days, **window).filter(F.col("dt") == date)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shoptide.plans.serving", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("report", choices=["total", "hours", "sales", "alerts"])
    parser.add_argument("--date", required=True)
    for name in ("--id", "--dau", "--first", "--orders", "--hours", "--sales", "--panes", "--docs", "--index", "--out", "--keyword"):
        parser.add_argument(name, default="")
    parser.add_argument("--page", type=int, default=1)
    parser.add_argument("--size", type=int, default=20)
    parser.add_argument("--by-relevance", action="store_true", help="sale rows with the best score first")
    args = parser.parse_args(argv)

    spark = build_session(f"shoptide-{args.report}")
    if args.report == "alerts":
        stored_alerts(spark, args.panes, args.date, args.docs).write.json(args.out)
        return
    if args.report == "total":
        out = total_json(stored_totals(spark, args.dau, args.orders, args.date, args.first))
    elif args.report == "hours":
        out = hours_json(stored_hours(spark, args.dau, args.orders, args.id, args.date, args.first, args.hours))
    else:
        out = sale_detail_json(stored_sales(spark, args.sales, args.date, args.keyword, args.page, args.size, args.index, args.by_relevance))
    print(out.first().json)


if __name__ == "__main__":
    main()
