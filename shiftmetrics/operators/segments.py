"""State-duration integration (J6, F1-F3, J1 for states).

Each sample opens a segment that ends at the next sample of the same
entity, at the shift's effective end, or ``cap`` after the sample,
whichever is first.  A sample carried in from before a shift counts only from
the shift start on, so it is the part of its segment that lies behind the
shift boundary: segments are made once, from all samples in one shuffle, and
cut where a shift ends.  (A carried sample older than ``cap`` adds no time.)
Durations are integer microseconds.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import Grid, cell_report_date, cell_shift_of, interval, micros_between, with_cell
from shiftmetrics.operators.carry import cell_dimension
from shiftmetrics.operators.chunked import DEFAULT_CHUNK, micros, time_chunk, width_us
from shiftmetrics.plans.scope import Scope


def capped_shares(samples: DataFrame, *, scope: Scope, grid: Grid, cols: list[str], entity: str | None = None,
                  cap: timedelta = timedelta(minutes=2), lookback: timedelta = timedelta(hours=12), clamp: bool = False,
                  shifts: tuple[int, ...] = (1, 2, 3), sample_filter: Column | None = None,
                  chunk: timedelta = DEFAULT_CHUNK, id_col: str = "id") -> DataFrame:
    """``report_date, shift, [entity], ts, id, *cols, dur_us``: each sample's share of a shift, if positive (C11).

    Windows run per (entity, time chunk), so a hot entity is split.  A
    segment is capped at ``cap``, so a row only needs its successor when it
    lies less than ``cap`` later: every row in the first ``cap`` of a chunk
    is also copied into the previous chunk as a look-ahead ("ghost") row.
    The last row of each chunk then sees the first rows of the next one,
    and a missing successor means the true one is at least ``cap`` away,
    where it does not change the result.  No second pass, no join.
    """
    if cap > lookback:
        raise ValueError("the cap on gaps must lie within the carry-in lookback")
    keys = [entity] if entity else []
    rows = samples if sample_filter is None else samples.filter(sample_filter)
    rows = scope.clip(rows, cap + timedelta(hours=grid.offset_hours), timedelta(hours=24 - grid.offset_hours))
    if clamp and scope.as_of is not None:
        rows = rows.filter(F.col("ts") < scope.as_of)
    rows = rows.select(*keys, "ts", F.col(id_col).alias("id"), *cols)

    width = max(chunk, cap)
    rows = rows.withColumn("_chunk", time_chunk("ts", width))
    since_start = micros("ts") - F.col("_chunk") * width_us(width)
    copies = F.when(since_start < width_us(cap), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_ghost", F.explode(copies)).withColumn("_chunk", F.col("_chunk") - F.col("_ghost"))
    ordered = Window.partitionBy(*keys, "_chunk").orderBy("ts", "id")
    rows = rows.withColumn("_next", F.lead("ts").over(ordered)).filter(F.col("_ghost") == 0)
    rows = rows.withColumn("_end", F.least(F.col("_next"), F.col("ts") + interval(cap))).drop("_next", "_ghost", "_chunk")

    rows = with_cell(rows, "ts", grid, scope.tz).drop("report_date", "shift")
    rows = rows.join(cell_dimension(scope, grid, clamp), "cell")
    own = micros_between("ts", F.least("_end", "end_eff"))
    # Behind the boundary the clamp is "now", but never before the boundary.
    tail_end = F.least("_end", F.greatest(F.col("end_ts"), scope.as_of)) if clamp and scope.as_of is not None else F.col("_end")
    tail = micros_between("end_ts", tail_end)
    shares = F.array(F.struct(F.col("cell"), own.alias("dur_us")), F.struct((F.col("cell") + 1).alias("cell"), tail.alias("dur_us")))
    rows = rows.select(*keys, "ts", "id", *cols, F.explode(shares).alias("_s")).filter(F.col("_s.dur_us") > 0)
    rows = rows.select(cell_report_date(F.col("_s.cell")).alias("report_date"), cell_shift_of(F.col("_s.cell")).alias("shift"),
                       *keys, "ts", "id", *cols, F.col("_s.dur_us").alias("dur_us"))
    return scope.keep(rows).filter(F.col("shift").isin(*shifts))
