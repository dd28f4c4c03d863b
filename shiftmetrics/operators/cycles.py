"""Disinfection cycle islands (J8, F5, F6, E5, E6, D10) from run fragments.

A cycle is a run of consecutive rows (by time, then record id) of one
machine with the same non-NULL operation.  The reference detects runs
inside a per-date window of local time, so the first row of a window
always opens a cycle; the result therefore depends on the window, and a
global sessionisation would count differently.  Here every row is copied
to the (at most two) report dates whose window contains it (``explode``).

Rows of (window date, machine) are grouped by time chunk, and a chunk is
reduced to the fragments of its runs: operation, first local time, largest
theoretical minutes.  Fragments inside a chunk are whole cycles.  Only the
first and the last one are open, to the left and to the right: these, at
most two a chunk, are merged along the chunks of the window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import interval, minutes_interval, to_local
from shiftmetrics.operators.chunked import DEFAULT_CHUNK, time_chunk
from shiftmetrics.plans.scope import Scope


def cycles_in_windows(machines: DataFrame, *, scope: Scope, machine_ids: tuple[int, ...],
                      before: timedelta, after: timedelta, day_offset: int = 0,
                      chunk: timedelta = DEFAULT_CHUNK) -> DataFrame:
    """Cycles found in the window ``[W - before, W + after)`` local of each window day W.

    ``W`` is the report date plus ``day_offset``.  Returns ``report_date, w,
    machine_id, operation_id, start_local, theoretical_min,
    scheduled_end_local`` where the scheduled end is the cycle's first local
    time plus its largest theoretical minutes.
    """
    if before > timedelta(hours=24) or after > timedelta(hours=48) - before:
        raise ValueError("cycle window must fit in two candidate window days")
    m = scope.clip(machines, before - timedelta(days=day_offset), after + timedelta(days=day_offset))
    m = (m.filter(F.col("operation_id").isNotNull() & F.col("machine_id").isin(*machine_ids))
         .select("machine_id", "ts", "record_id", "operation_id", "theoretical_min"))
    m = m.withColumn("local", to_local(F.col("ts"), scope.tz))
    # The window of day W holds local times in [W - before, W + after); with
    # before <= 24 h and before + after <= 48 h the only candidates are the
    # day of (local + before) and the day before it.
    d1 = (F.col("local") + interval(before)).cast("date")
    m = m.withColumn("w", F.explode(F.array(d1, F.date_sub(d1, 1))))
    w_start = F.col("w").cast("timestamp_ntz") - interval(before)
    w_end = F.col("w").cast("timestamp_ntz") + interval(after)
    m = m.filter((F.col("local") >= w_start) & (F.col("local") < w_end))
    m = scope.keep(m.withColumn("report_date", F.date_sub("w", day_offset)))

    group = ["report_date", "w", "machine_id"]
    m = m.withColumn("_chunk", time_chunk("ts", chunk))
    rows = Window.partitionBy(*group, "_chunk").orderBy("ts", "record_id")
    m = m.withColumn("_opens", F.lag("operation_id").over(rows).eqNullSafe(F.col("operation_id")) == F.lit(False))
    # A fragment is named by the row that opens it.
    m = m.withColumn("_run", F.last(F.when(F.col("_opens"), F.struct("ts", "record_id", "operation_id")), ignorenulls=True).over(
        rows.rowsBetween(Window.unboundedPreceding, 0)))
    fragments = m.groupBy(*group, "_chunk", "_run").agg(
        F.min("operation_id").alias("operation_id"), F.min("local").alias("start_local"),
        F.max("theoretical_min").alias("theoretical_min"))

    in_chunk = Window.partitionBy(*group, "_chunk").orderBy("_run")
    fragments = fragments.select("*", F.lag("_run").over(in_chunk).isNull().alias("_left"),
                                 F.lead("_run").over(in_chunk).isNull().alias("_right"))
    closed = fragments.filter(~F.col("_left") & ~F.col("_right"))
    open_ends = fragments.filter(F.col("_left") | F.col("_right"))
    # An open fragment goes on if the one before it is open to it and has its operation.
    along = Window.partitionBy(*group).orderBy("_chunk", "_run")
    goes_on = F.col("_left") & F.lag(F.when(F.col("_right"), F.col("operation_id"))).over(along).eqNullSafe(F.col("operation_id"))
    open_ends = open_ends.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    open_ends = open_ends.withColumn("_cycle", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = open_ends.groupBy(*group, "_cycle").agg(
        F.min("operation_id").alias("operation_id"), F.min("start_local").alias("start_local"),
        F.max("theoretical_min").alias("theoretical_min"))
    cols = [*group, "operation_id", "start_local", "theoretical_min"]
    c = merged.select(*cols).unionByName(closed.select(*cols))
    return c.withColumn("scheduled_end_local",
                        F.col("start_local") + minutes_interval(F.col("theoretical_min")))
