"""Counter activity: the largest step of a cumulative counter per report day.

The reference looks at the non-NULL samples in the closed window
``[D 06:00, D+1 06:00]`` plus the last non-NULL sample before it, and asks
whether any consecutive step reaches a minimum.  The predecessor of a sample
inside a window is its predecessor in the whole table, so steps do not depend
on the window: samples are grouped by (day from 06:00 on, time chunk), a group's
record holds its first and last row and its largest step, and the records
in order of time are merged with the steps between neighbours.  All that is
needed of the history before the first day is its last value: one partially
aggregated row.  A sample exactly at 06:00 closes the previous day's window
too, so its step also counts there.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import interval, to_local
from shiftmetrics.operators.carry import _scope_day_bounds
from shiftmetrics.operators.chunked import DEFAULT_CHUNK, time_chunk
from shiftmetrics.plans.scope import Scope


def largest_steps(counters: DataFrame, value: str, *, scope: Scope, day_start: timedelta,
                  chunk: timedelta = DEFAULT_CHUNK) -> DataFrame:
    """``report_date, step``: the largest step ``value - previous value`` of each report day that has samples
    (NULL if its only sample is the first of all)."""
    samples = counters.filter(F.col(value).isNotNull())
    lo, hi = _scope_day_bounds(scope)
    # The closing instant of the last window is 06:00 of the day after it.
    recent = scope.clip(samples, -day_start, timedelta(days=1) + day_start)
    earlier = scope.clip(samples, None, day_start, days="first")

    def with_day(df: DataFrame) -> DataFrame:
        df = df.select("ts", "id", F.col(value).alias("v"))
        local = to_local(F.col("ts"), scope.tz) - interval(day_start)
        return df.select("ts", "id", "v", F.datediff(local.cast("date"), F.lit("1970-01-01")).alias("d"),
                         (local == local.cast("date").cast("timestamp_ntz")).alias("at_edge"))

    rows = with_day(recent).filter((F.col("d") >= lo) & (F.col("d") <= hi + 1)).withColumn("_chunk", time_chunk("ts", chunk))
    before = F.lag("v").over(Window.partitionBy("d", "_chunk").orderBy("ts", "id"))
    rows = rows.withColumn("_step", F.col("v") - before)
    record = F.struct("ts", "id", "v", "at_edge")
    summary = rows.groupBy("d", "_chunk").agg(
        F.min(record).alias("first"), F.max(record).alias("last"), F.max("_step").alias("_inside"),
        F.max(F.when(F.col("at_edge"), F.col("_step"))).alias("_inside_edge"))
    opening = with_day(earlier).filter(F.col("d") < lo).agg(F.max(record).alias("last")).filter("last is not null")
    summary = summary.unionByName(opening.select(
        (lo - 1).cast("int").alias("d"), F.lit(None).cast("long").alias("_chunk"), "last"), allowMissingColumns=True)

    # A few rows a day: the series of all records.
    series = Window.orderBy(F.col("d"), F.col("_chunk").asc_nulls_first())
    edge = F.col("first.v") - F.lag("last.v").over(series)
    summary = summary.select("d", "first", "_inside", "_inside_edge", edge.alias("_edge")).filter(F.col("first").isNotNull())
    own = F.struct(F.col("d"), F.greatest("_inside", "_edge").alias("step"))
    shared = F.struct((F.col("d") - 1).alias("d"), F.greatest("_inside_edge", "_edge").alias("step"))
    steps = summary.select(F.explode(F.when(F.col("first.at_edge"), F.array(own, shared)).otherwise(F.array(own))).alias("s"))
    steps = steps.select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("s.d").cast("int")).alias("report_date"), "s.step")
    return scope.keep(steps.groupBy("report_date").agg(F.max("step").alias("step")))
