"""Carry-in, as-of lookups and snapshots (J1, J2, J10; D3-D5, G1, G2).

All three answer "what was the last sample before instant X?" without a
range join and without a window over a whole entity history:

* ``carried_in`` (bounded lookback): keep the last sample of every
  (entity, shift cell) with a partially aggregated ``max_by``, hand it to
  the next cells that its lookback can reach (``explode``), keep the latest
  one inside the lookback.  (Level gains and state durations get theirs from
  the samples' own shuffle, see ``levels`` and ``segments``.)
* ``asof_at_boundaries`` / ``daily_snapshot`` (unbounded lookback): reduce
  samples to one "last value" per bucket between consecutive boundaries, then
  let each bucket value stand for every boundary up to the next non-empty
  bucket (``lead`` over the bucket series, then ``explode(sequence(...))``
  clipped to the scope).  The bucket series has at most three rows per day
  and entity, so it is calendar-sized whatever the sample rate.

``max_by(struct, struct(ts, id))`` makes "latest" deterministic on equal
timestamps (the reference leaves ties undefined).
"""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.functions.timegrid import (
    Grid, cell_date, cell_index, cell_report_date, cell_shift, cell_shift_of, clamp_end,
    interval, to_local, with_bounds, with_cell,
)
from shiftmetrics.plans.scope import Scope

ONE_US = timedelta(microseconds=1)
SHORTEST_SHIFT = timedelta(hours=7)   # an 8-hour shift on a spring-forward day


def latest(rec: Column, ts: str = "ts", id_col: str = "id") -> Column:
    """``max_by(rec, (ts, id))``: the latest record, ties broken by id."""
    return F.max_by(rec, F.struct(F.col(ts), F.col(id_col)))


def carried_in(samples: DataFrame, *, scope: Scope, grid: Grid, cols: list[str], entity: str,
               lookback: timedelta = timedelta(hours=12), shifts: tuple[int, ...] = (1, 2, 3), id_col: str = "id") -> DataFrame:
    """The last sample of each entity in the ``lookback`` before each shift.

    Returns ``report_date, shift, entity, ts, id, *cols`` (own timestamp kept).
    Samples collapse to the last one per (entity, shift cell) on the map side.
    """
    base = scope.clip(samples, lookback + timedelta(hours=grid.offset_hours), timedelta(hours=24 - grid.offset_hours))
    cells = with_cell(base.select(entity, "ts", F.col(id_col).alias("id"), *cols), "ts", grid, scope.tz)
    last = cells.groupBy(entity, "cell").agg(latest(F.struct("ts", "id", *cols)).alias("r"))
    reach = max(1, math.ceil(lookback / SHORTEST_SHIFT))
    targets = F.array(*[F.col("cell") + i for i in range(1, reach + 1)])
    carry = (last.select(entity, F.explode(targets).alias("cell"), "r")
             .withColumn("report_date", cell_report_date(F.col("cell")))
             .withColumn("shift", cell_shift_of(F.col("cell")))
             .filter(F.col("shift").isin(*shifts)))
    carry = with_bounds(scope.keep(carry), grid, scope.tz)
    carry = carry.filter(F.col("r.ts") >= F.col("start_ts") - interval(lookback))
    return (carry.groupBy("report_date", "shift", entity)
            .agg(F.max_by("r", F.struct("r.ts", "r.id")).alias("r"))
            .select("report_date", "shift", entity, "r.ts", "r.id", *[f"r.{c}" for c in cols]))


def cell_dimension(scope: Scope, grid: Grid, clamp: bool = False) -> DataFrame:
    """``cell, end_ts, end_eff`` of every shift in scope and the one before each date.

    Four rows per report date (a proven bound), broadcast: shift ends are
    looked up by the computed key instead of being converted from local
    time on every sample row.
    """
    days = scope.dates.select((F.datediff("report_date", F.lit("1970-01-01")).cast("long") * 3).alias("d"))
    s = days.select(F.explode(F.array(*[F.col("d") + k for k in (-1, 0, 1, 2)])).alias("cell")).distinct()
    s = s.withColumns({"report_date": cell_report_date(F.col("cell")), "shift": cell_shift_of(F.col("cell"))})
    s = with_bounds(s, grid, scope.tz)
    end = clamp_end(F.col("start_ts"), F.col("end_ts"), scope.as_of if clamp else None)
    return F.broadcast(s.select("cell", "end_ts", end.alias("end_eff")))


def valid_ranges(buckets: DataFrame, keys: list[str], pos: str, lo: Column, hi: Column,
                  offset: int = 0) -> DataFrame:
    """Explode each bucket over the positions it answers for.

    A bucket at ``pos`` answers for positions ``pos + offset`` up to the
    position before the next bucket's (same keys), clipped to ``[lo, hi]``.
    """
    w = Window.partitionBy(*keys).orderBy(pos)
    nxt = F.lead(pos).over(w)
    first = F.greatest(F.col(pos) + offset, lo)
    last = F.least(F.coalesce(nxt + offset - 1, hi), hi)
    return (buckets.withColumn("_first", first).withColumn("_last", last)
            .filter(F.col("_first") <= F.col("_last"))
            .withColumn(pos, F.explode(F.sequence("_first", "_last")))
            .drop("_first", "_last"))


def asof_at_boundaries(samples: DataFrame, *, scope: Scope, grid: Grid, cols: list[str],
                       boundary_lo: Column, boundary_hi: Column, reach: timedelta = timedelta(hours=32),
                       id_col: str = "id") -> DataFrame:
    """Latest sample with ``ts <= boundary`` for every shift boundary.

    Boundary ``b`` is the start instant of cell ``b`` of ``grid``.  Returns
    ``b, v`` where ``v`` is the struct of ``cols`` of the latest row (its
    fields may be NULL, as the reference's ``LIMIT 1`` returns them), for
    ``boundary_lo <= b <= boundary_hi``; boundaries with no earlier sample
    are absent.  ``reach``: the last boundary after the last date's local midnight.
    """
    s = scope.clip(samples, None, reach).select("ts", F.col(id_col).alias("id"), *cols)
    loc = to_local(F.col("ts") - interval(ONE_US), scope.tz)
    s = s.withColumn("b", cell_index(cell_date(loc, grid), cell_shift(loc, grid)) + 1)
    buckets = s.groupBy("b").agg(latest(F.struct(*cols)).alias("v"))
    return valid_ranges(buckets, [], "b", boundary_lo, boundary_hi)


def daily_snapshot(samples: DataFrame, *, scope: Scope, entity: str, value: str,
                   at: timedelta, id_col: str = "id") -> DataFrame:
    """Latest ``value`` per entity with ``ts <= D+1 at`` local, per report date.

    Returns ``report_date, entity, v`` (``v`` may be NULL when the latest
    row's value is NULL) for the scope's dates that have an earlier sample.
    """
    s = scope.clip(samples, None, timedelta(days=1) + at).select(entity, "ts", F.col(id_col).alias("id"), value)
    loc = to_local(F.col("ts"), scope.tz) - interval(at + ONE_US)
    s = s.withColumn("report_date", loc.cast("date"))
    buckets = s.groupBy(entity, "report_date").agg(latest(F.struct(value)).alias("r"))
    days = buckets.withColumn("d", F.datediff("report_date", F.lit("1970-01-01")))
    lo, hi = _scope_day_bounds(scope)
    out = valid_ranges(days, [entity], "d", lo, hi)
    out = out.withColumn("report_date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("d").cast("int")))
    return scope.keep(out.select("report_date", entity, F.col(f"r.{value}").alias("v")))


def _scope_day_bounds(scope: Scope) -> tuple[Column, Column]:
    """Days since epoch of the first and last report date (literals when known)."""
    if scope.first is not None and scope.last is not None:
        epoch = date(1970, 1, 1)
        return F.lit((scope.first - epoch).days), F.lit((scope.last - epoch).days)
    d = scope.dates.select(F.datediff("report_date", F.lit("1970-01-01")).alias("d"))
    return d.select(F.min("d")).scalar(), d.select(F.max("d")).scalar()


def scope_cell_bounds(scope: Scope, first_offset: int = 0, last_offset: int = 3) -> tuple[Column, Column]:
    """Cell range ``[3*first_day + first_offset, 3*last_day + last_offset]`` of the scope."""
    lo, hi = _scope_day_bounds(scope)
    return lo.cast("long") * 3 + first_offset, hi.cast("long") * 3 + last_offset


__all__ = ["carried_in", "cell_dimension", "asof_at_boundaries", "daily_snapshot", "valid_ranges",
           "scope_cell_bounds", "latest"]
