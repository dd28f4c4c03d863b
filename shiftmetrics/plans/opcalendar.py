"""Operational calendar and report-day selection.

The calendar is a dimension with one row per report date; it is built with
``sequence``/``explode`` and windows over that date dimension only (never
over sensor rows), so its size is the number of days in scope.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftmetrics.config import DEFAULT_CONFIG, Config
from shiftmetrics.functions.formatting import US_PER_S
from shiftmetrics.functions.timegrid import date_at, micros_between, to_local, to_utc
from shiftmetrics.plans.scope import Scope


def holidays_frame(spark: SparkSession, raw: str) -> DataFrame:
    """Holiday dates from a comma-separated ISO list; blank items ignored."""
    items = spark.createDataFrame([(raw,)], "raw string").select(
        F.explode(F.split("raw", ",")).alias("item"))
    return (items.select(F.trim("item").alias("item")).filter(F.col("item") != "")
            .select(F.to_date("item").alias("day")).distinct())


def operational_calendar(scope: Scope, holidays: DataFrame,
                         cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Per report date: weekday/holiday flags, previous/next operational day,
    seconds to the next operational day from the date at the wall-clock time of
    "now" (min 60), labels and the report-ready instant (B9, B11-B14, B16).

    The search for operational days has no limit: days without operation in a
    row are weekends and holidays, so twice the number of holidays and a few
    days more always reach past them.
    """
    pad = holidays.select((2 * F.count(F.lit(1)) + 9).cast("int")).scalar()
    span = scope.dates.agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi")).withColumn("pad", pad)
    days = span.select(F.explode(F.sequence(F.expr("date_sub(lo, pad)"), F.expr("date_add(hi, pad)")))
                       .alias("report_date"))
    hol = holidays.select(F.col("day").alias("report_date"), F.lit(True).alias("is_holiday")).distinct()
    cal = (days.join(hol, "report_date", "left")
           .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
           .withColumn("is_weekday", F.weekday("report_date") < 5)
           .withColumn("is_operational", F.col("is_weekday") & ~F.col("is_holiday")))
    op_day = F.when(F.col("is_operational"), F.col("report_date"))
    w = Window.orderBy("report_date")
    cal = (cal.withColumn("previous_operational_day",
                          F.last(op_day, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("next_operational_day",
                          F.first(op_day, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))))
    # Wall-clock difference: clock changes in between do not count.
    elapsed = F.lit(0).cast("long")
    if scope.as_of is not None:
        now = to_local(scope.as_of, scope.tz)
        elapsed = micros_between(now.cast("date").cast("timestamp_ntz"), now)
    day_us = F.datediff("next_operational_day", "report_date").cast("long") * 86_400 * US_PER_S
    wait = F.floor((day_us - elapsed) / US_PER_S)
    cal = cal.withColumn("seconds_to_next_operational", F.greatest(F.lit(60).cast("long"), wait))
    ready = to_utc(date_at(F.date_add("report_date", 1), cfg.report_ready_at), scope.tz)
    cal = (cal.withColumn("ready_at_utc", ready)
              .withColumn("report_label", F.date_format("report_date", "dd/MM/yyyy"))
              .withColumn("snapshot_label", F.date_format(F.date_add("report_date", 1), "dd/MM/yyyy"))
              .withColumn("current_label", F.concat(
                  F.lit("Atual 00-08 ("), F.date_format(F.date_add("report_date", 1), "dd/MM"), F.lit(")"))))
    out = scope.keep(cal)
    return out.select("report_date", "is_weekday", "is_holiday", "is_operational",
                      "previous_operational_day", "next_operational_day",
                      "seconds_to_next_operational", "ready_at_utc", "report_label",
                      "snapshot_label", "current_label")


def report_days(calendar: DataFrame, activity: DataFrame, as_of=None) -> DataFrame:
    """Report dates to send: operational, or with activity (B15), and whether
    the report is ready at ``as_of`` (B14)."""
    c = calendar.join(activity.select("report_date", "has_production"), "report_date", "left")
    c = c.withColumn("has_production", F.coalesce("has_production", F.lit(False)))
    c = c.withColumn("send", F.col("is_operational") | F.col("has_production"))
    ready = (as_of >= F.col("ready_at_utc")) if as_of is not None else F.lit(True)
    return c.select("report_date", "is_operational", "has_production", "send",
                    ready.alias("is_ready"))


__all__ = ["holidays_frame", "operational_calendar", "report_days"]


def calendar_query(t, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Registered form of ``operational_calendar`` (instant as text), with the MD samples of each local day."""
    day = to_local(F.col("ts"), scope.tz).cast("date").alias("report_date")
    n = scope.clip(t.md, timedelta(0), timedelta(hours=24)).groupBy(day).agg(F.count(F.lit(1)).alias("n_samples"))
    cal = operational_calendar(scope, t.holidays, cfg).join(n, "report_date", "left")
    cal = cal.withColumn("n_samples", F.coalesce("n_samples", F.lit(0)))
    return cal.withColumn("ready_at_utc", F.date_format("ready_at_utc", "yyyy-MM-dd HH:mm:ss"))


def report_days_query(t, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Registered form of ``report_days``: calendar + activity (Q01) + readiness."""
    from shiftmetrics.plans.activity import report_activity
    cal = operational_calendar(scope, t.holidays, cfg)
    return report_days(cal, report_activity(t, scope, cfg), scope.as_of)
