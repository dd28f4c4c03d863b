"""Point-in-time state sweep for both shift grids.

Question: at each status sample, is *any* silo in a given state?  A silo's
state holds from its sample until its next sample (start inclusive, end
exclusive).  Instead of an interval join, every silo sample emits the
change it makes to "number of silos in the state" (+1 entering, -1
leaving, 0 otherwise); a running sum gives the count at every instant.

The count does not depend on shifts, so one stream of events serves every
grid.  It runs per time chunk: a chunk opens with one row per silo, its state
at that instant (unbounded lookback, from the last row of each silo and chunk,
partially aggregated; all history before the first chunk is one row a silo).

A status segment runs to the next status sample of its shift or to the shift
end, without cap (F3).  Inside a chunk segments are closed at once, cut where
their shift ends, once per grid.  A chunk's last segment stays open: the
chunk's record keeps it together with the chunk's first sample and the sums of
the closed ones, and merging the records in order of time closes it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import (
    CAL_GRID, DAY_GRID, Grid, cell_report_date, cell_shift_of, shift_start_local, to_utc, with_cell,
)
from shiftmetrics.operators.carry import valid_ranges
from shiftmetrics.operators.chunked import DEFAULT_CHUNK, micros, time_chunk, width_us
from shiftmetrics.plans.scope import Scope

GRIDS = {"cal": CAL_GRID, "day": DAY_GRID}
CLASSES = ("prod", "idle", "off")


def _end_us(cell: Column, grid: Grid, tz: str) -> Column:
    """Microseconds of the end of a shift cell."""
    after = cell + 1
    return micros(to_utc(shift_start_local(cell_report_date(after), cell_shift_of(after), grid), tz))


def _status_rows(status: DataFrame, flag: Column, scope: Scope, lo: timedelta, hi: timedelta, chunk: timedelta) -> DataFrame:
    rows = scope.clip(status, lo, hi).select("ts", flag.cast("int").alias("flag"))
    for name, grid in GRIDS.items():
        rows = with_cell(rows, "ts", grid, scope.tz).drop("report_date", "shift").withColumnRenamed("cell", name)
    return rows.select(time_chunk("ts", chunk).alias("_chunk"), micros("ts").alias("us"), "flag", *GRIDS)


def _duration(name: str, following: Column, tz: str) -> Column:
    """From a sample to ``following`` (a struct of us and cells), cut at the end of the sample's cell of grid ``name``."""
    end = F.when(following[name] == F.col(name), following["us"]).otherwise(_end_us(F.col(name), GRIDS[name], tz))
    return end - F.col("us")


def status_samples(status: DataFrame, flag: Column, silos: DataFrame, *, scope: Scope, lo: timedelta, hi: timedelta,
                   target_state: int = 2, chunk: timedelta = DEFAULT_CHUNK) -> DataFrame:
    """Status samples from ``lo`` before the first to ``hi`` after the last local midnight of the scope.

    ``status`` has ``ts`` and whatever ``flag`` reads; ``silos`` has ``silo_id,
    ts, id, state``.  Returns ``_chunk, us, flag, cal, day`` (cells of the two
    grids), ``any_state`` and ``following`` (the next sample of the chunk, if any).
    """
    st = _status_rows(status, flag, scope, lo, hi, chunk)
    first, last = scope.instants(lo, hi)
    if first is None:    # the scope is not literal: the span of the samples
        first_chunk, last_chunk = st.agg(F.min("_chunk")).scalar(), st.agg(F.max("_chunk")).scalar()
    else:
        first_chunk, last_chunk = time_chunk(first, chunk), time_chunk(last, chunk)

    is_in = F.when(F.col("state") == target_state, 1).otherwise(0)
    known = scope.clip(silos, None, hi).select("silo_id", "ts", "id", is_in.alias("is_in"), time_chunk("ts", chunk).alias("_chunk"))
    bucket = F.greatest(F.col("_chunk"), first_chunk - 1)
    last_rows = known.groupBy("silo_id", bucket.alias("_chunk")).agg(F.max(F.struct("ts", "id", "is_in")).alias("r"))
    opening = valid_ranges(last_rows, ["silo_id"], "_chunk", first_chunk, last_chunk, offset=1)

    changes = scope.clip(silos, lo + chunk, hi)    # from the first chunk's start on
    changes = changes.select(time_chunk("ts", chunk).alias("_chunk"), micros("ts").alias("us"), F.lit(1).alias("kind"), "id", "silo_id",
                             is_in.alias("is_in")).filter(F.col("_chunk") >= first_chunk)
    events = (opening.select("_chunk", (F.col("_chunk") * width_us(chunk)).alias("us"), F.lit(0).alias("kind"),
                             F.lit(None).cast("long").alias("id"), "silo_id", F.col("r.is_in").alias("is_in"))
              .unionByName(changes)
              .unionByName(st.withColumn("kind", F.lit(2)), allowMissingColumns=True))
    # One shuffle: all windows below run inside a chunk.
    events = events.repartition("_chunk").withColumn("is_status", F.col("kind") == 2)
    own = Window.partitionBy("_chunk", "is_status", "silo_id").orderBy("us", "kind", "id")
    change = F.col("is_in") - F.coalesce(F.lag("is_in").over(own), F.lit(0))
    events = events.withColumn("_change", F.when(~F.col("is_status"), change).otherwise(0))
    # RANGE UNBOUNDED PRECEDING .. CURRENT ROW: peers at equal times are included,
    # so a state that starts at t covers t and one that ends at t does not.
    count = F.sum("_change").over(Window.partitionBy("_chunk").orderBy("us"))
    events = events.withColumn("any_state", F.when(count > 0, 1).otherwise(0)).filter("is_status")
    following = F.lead(F.struct("us", *GRIDS)).over(Window.partitionBy("_chunk").orderBy("us", "flag"))
    return events.select("_chunk", "us", "flag", *GRIDS, "any_state", following.alias("following"))


def state_time(samples: DataFrame, scope: Scope) -> DataFrame:
    """Merged records of ``status_samples``: per chunk and cell of both grids, microseconds by class and grid
    (``cal_prod, cal_idle, cal_off, day_prod, ...``)."""
    on, busy = F.col("flag") == 1, F.col("any_state") == 1
    kinds = {"prod": on & busy, "idle": on & ~busy, "off": ~on}
    is_open = F.col("following").isNull()
    sums = [F.sum(F.when(kind & ~is_open, _duration(name, F.col("following"), scope.tz)).otherwise(0)).alias(f"{name}_{c}")
            for name in GRIDS for c, kind in kinds.items()]
    records = samples.groupBy("_chunk", *GRIDS).agg(
        F.min(F.struct("us", *GRIDS)).alias("_first"), F.max(F.when(is_open, F.struct("us", "flag", "any_state"))).alias("_open"), *sums)
    # A few rows an hour: the series of all records.
    series = Window.orderBy("_chunk", *GRIDS)
    records = records.withColumn("following", F.lead("_first").over(series))
    records = records.select("*", F.col("_open.us").alias("us"), F.col("_open.flag").alias("flag"), F.col("_open.any_state").alias("any_state"))

    def closed(name: str, c: str) -> Column:
        end = F.when(F.col("following").isNull(), _end_us(F.col(name), GRIDS[name], scope.tz) - F.col("us")).otherwise(
            _duration(name, F.col("following"), scope.tz))
        return (F.col(f"{name}_{c}") + F.when(kinds[c] & F.col("us").isNotNull(), end).otherwise(0)).alias(f"{name}_{c}")

    return records.select("_chunk", *GRIDS, *[closed(name, c) for name in GRIDS for c in CLASSES])


def segments(samples: DataFrame, status: DataFrame, flag: Column, name: str, *, scope: Scope, lo: timedelta, hi: timedelta,
             chunk: timedelta = DEFAULT_CHUNK) -> DataFrame:
    """Row level: ``report_date, shift, ts, flag, any_state, dur_us`` of every status segment of grid ``name``.

    One row per (ts, flag), as the reference's GROUP BY gives (E10): a repeated sample opens an empty segment.
    """
    first = _status_rows(status, flag, scope, lo, hi, chunk).groupBy("_chunk").agg(F.min(F.struct("us", *GRIDS)).alias("_first"))
    ahead = first.select("_chunk", F.lead("_first").over(Window.orderBy("_chunk")).alias("_ahead"))
    rows = samples.join(ahead, "_chunk", "left").withColumn("following", F.coalesce("following", "_ahead"))
    end = F.when(F.col("following").isNull(), _end_us(F.col(name), GRIDS[name], scope.tz) - F.col("us")).otherwise(
        _duration(name, F.col("following"), scope.tz))
    rows = rows.select(name, "us", "flag", "any_state", end.alias("dur_us")).groupBy(name, "us", "flag").agg(
        F.max("any_state").alias("any_state"), F.max("dur_us").alias("dur_us"))
    seconds = (F.col("us").cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    ts = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return rows.select(cell_report_date(F.col(name)).alias("report_date"), cell_shift_of(F.col(name)).alias("shift"),
                       ts.alias("ts"), "flag", "any_state", "dur_us")
