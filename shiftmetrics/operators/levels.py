"""State-gated level gain (J7, F4, E3) from mergeable step summaries.

The weight gained in a shift is the sum of positive steps between
consecutive samples of a silo, counted only when the later sample's state
is "filling" (1).  The sample carried in from before the shift only serves as
the first predecessor; a NULL level makes both adjacent steps NULL (not
counted).

Samples are grouped by (silo, shift cell, time chunk).  One pass over a group
gives its record: first row, last row, gain inside.  Records of a silo in order
of time are merged by adding the step between neighbours.  The record before a
shift's first one ends with the sample that is carried in, so the carry-in
needs no pass of its own; it counts if it lies within the lookback.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import Grid, cell_report_date, cell_shift_of, interval, with_bounds, with_cell
from shiftmetrics.operators.chunked import DEFAULT_CHUNK, time_chunk
from shiftmetrics.plans.scope import Scope


def level_gain(samples: DataFrame, *, scope: Scope, grid: Grid, entity: str = "silo_id", level: str = "kg", state: str = "state",
               filling: int = 1, lookback: timedelta = timedelta(hours=12), chunk: timedelta = DEFAULT_CHUNK,
               shifts: tuple[int, ...] = (1, 2, 3), carry_filter: Column | None = None,
               sample_filter: Column | None = None, id_col: str = "id") -> DataFrame:
    """``report_date, shift, entity, gain, gain_before``: gain of each shift, and of its samples before ``scope.as_of``.

    (Later samples come last in a silo's sequence, so leaving them out changes no earlier step.)
    ``carry_filter``: condition on the entity for a carried sample to count; ``sample_filter``: for all samples.
    """
    rows = samples if sample_filter is None else samples.filter(sample_filter)
    rows = scope.clip(rows, lookback + timedelta(hours=grid.offset_hours), timedelta(hours=24 - grid.offset_hours))
    rows = rows.select(entity, "ts", F.col(id_col).alias("id"), F.col(level).alias("_level"), F.col(state).alias("_state"))
    rows = with_cell(rows, "ts", grid, scope.tz).drop("report_date", "shift").withColumn("_chunk", time_chunk("ts", chunk))

    def gain(later: Column, later_state: Column, earlier: Column) -> Column:
        step = later - earlier
        return F.when((later_state == filling) & (step > 0), step).otherwise(F.lit(0))

    keys = [entity, "cell", "_chunk"]
    before = F.lag("_level").over(Window.partitionBy(*keys).orderBy("ts", "id"))
    rows = rows.withColumn("_gain", gain(F.col("_level"), F.col("_state"), before))
    in_time = F.col("ts") < scope.as_of if scope.as_of is not None else F.lit(True)
    record = F.struct("ts", "id", "_level", "_state")
    summary = rows.groupBy(*keys).agg(
        F.min(record).alias("first"), F.max(record).alias("last"), F.sum("_gain").alias("_inside"),
        F.sum(F.when(in_time, F.col("_gain")).otherwise(0)).alias("_inside_before"))

    series = Window.partitionBy(entity).orderBy("cell", "_chunk")
    summary = summary.select("*", F.lag("last").over(series).alias("_prev"), F.lag("cell").over(series).alias("_prev_cell"))
    summary = summary.withColumns({"report_date": cell_report_date(F.col("cell")), "shift": cell_shift_of(F.col("cell"))})
    summary = scope.keep(summary).filter(F.col("shift").isin(*shifts))
    summary = with_bounds(summary, grid, scope.tz)
    carried = F.col("_prev.ts") >= F.col("start_ts") - interval(lookback)
    if carry_filter is not None:
        carried = carried & carry_filter
    known = (F.col("_prev_cell") == F.col("cell")) | carried
    edge = F.when(known, gain(F.col("first._level"), F.col("first._state"), F.col("_prev._level"))).otherwise(F.lit(0))
    first_in_time = F.col("first.ts") < scope.as_of if scope.as_of is not None else F.lit(True)
    summary = summary.withColumn("_edge", edge)
    return summary.groupBy("report_date", "shift", entity).agg(
        F.sum(F.col("_inside") + F.col("_edge")).alias("gain"),
        F.sum(F.col("_inside_before") + F.when(first_in_time, F.col("_edge")).otherwise(0)).alias("gain_before"))
