"""Building blocks exposed as queries, so each operator is checked alone.

Each returns a small per-shift (or per-date) summary of one operator run
over the whole sensor tables: the grids (B3, B4), the clamp (B6), the
carry-in (J1), the as-of lookup (J2), capped segments (J6), the sweep (J5)
and the cycle islands (J8).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftmetrics.config import DEFAULT_CONFIG, VAPEX_GRINDING, VAPEX_VINC, Config
from shiftmetrics.functions.formatting import US_PER_S
from shiftmetrics.functions.timegrid import (
    CAL_GRID, DAY_GRID, Grid, clamp_end, micros_between, with_bounds, with_cell,
)
from shiftmetrics.operators.carry import asof_at_boundaries, carried_in, scope_cell_bounds
from shiftmetrics.operators.cycles import cycles_in_windows
from shiftmetrics.operators.segments import capped_shares
from shiftmetrics.operators.sweep import segments, status_samples
from shiftmetrics.plans.calibration import REACH, calibration_state_time, sieve_running
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.tables import SensorTables

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _grid_cells(samples: DataFrame, scope: Scope, grid: Grid) -> DataFrame:
    near = scope.clip(samples, timedelta(hours=grid.offset_hours), timedelta(hours=24 - grid.offset_hours))
    cells = with_cell(near.select("ts"), "ts", grid, scope.tz)
    n = scope.keep(cells).groupBy("report_date", "shift").agg(F.count("*").alias("n_samples"))
    shifts = scope.dates.select("report_date", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("shift"))
    out = with_bounds(shifts.join(n, ["report_date", "shift"], "left").fillna({"n_samples": 0}),
                      grid, scope.tz)
    return out.select("report_date", "shift",
                      F.date_format("start_ts", TS_FMT).alias("start_utc"),
                      F.date_format("end_ts", TS_FMT).alias("end_utc"),
                      (micros_between("start_ts", "end_ts") / US_PER_S).cast("long").alias("length_s"),
                      "n_samples")


def shift_grid_day(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Day grid (B3): bounds and MD sample count of every 00/08/16 shift."""
    return _grid_cells(t.md, scope, DAY_GRID)


def shift_grid_calibration(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Calibration grid (B4): bounds and re-milling sample count of every 22/06/14 shift."""
    return _grid_cells(t.remill, scope, CAL_GRID)


def window_clamp(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Clamp to "now" (B6): effective end and length of every day shift, and its MD samples before that end."""
    shifts = scope.dates.select("report_date", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("shift"))
    s = with_bounds(shifts, DAY_GRID, scope.tz)
    s = s.withColumn("end_eff", clamp_end(F.col("start_ts"), F.col("end_ts"), scope.as_of))
    md = with_cell(scope.clip(t.md, timedelta(0), timedelta(hours=24)).select("ts"), "ts", DAY_GRID, scope.tz)
    if scope.as_of is not None:
        md = md.filter(F.col("ts") < scope.as_of)
    n = scope.keep(md).groupBy("report_date", "shift").agg(F.count(F.lit(1)).alias("n_samples"))
    s = s.join(n, ["report_date", "shift"], "left")
    return s.select("report_date", "shift", F.date_format("end_eff", TS_FMT).alias("end_eff_utc"),
                    micros_between("start_ts", "end_eff").alias("eff_us"),
                    F.coalesce("n_samples", F.lit(0)).alias("n_samples"))


def carry_in_latest(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Carry-in (J1): last silo 1-5 sample in the 12 h before each day shift."""
    c = carried_in(t.silos_a, scope=scope, grid=DAY_GRID, entity="silo_id", cols=["state", "kg"],
                   lookback=cfg.carry_lookback)
    return c.select("report_date", "shift", "silo_id",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("carry_ts"), "id", "state", "kg")


def counter_asof(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """As-of (J2): counter row (``<=``, unbounded) at every calibration shift start."""
    lo, hi = scope_cell_bounds(scope, 0, 3)
    src = t.counters.withColumn("row_id", F.col("id"))
    a = asof_at_boundaries(src, scope=scope, grid=CAL_GRID, cols=["total", "p1_2", "row_id"],
                           boundary_lo=lo, boundary_hi=hi)
    a = a.select(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("b") / 3).cast("int")).alias("report_date"),
                 (F.pmod(F.col("b"), F.lit(3)) + 1).cast("int").alias("shift"),
                 F.col("v.row_id").alias("asof_id"), F.col("v.total").cast("double").alias("total"),
                 F.col("v.p1_2").cast("double").alias("p1_2"))
    return scope.keep(a)


def segment_durations(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Capped segments (J6): seconds covered per screw 1-5 and day shift, any frequency."""
    ids = F.col("sf_id").isin(*cfg.mill_screws)
    d = capped_shares(t.screws, scope=scope, grid=DAY_GRID, entity="sf_id", cols=["freq"], cap=cfg.gap_cap,
                      lookback=cfg.carry_lookback, clamp=True, sample_filter=ids, chunk=cfg.window_chunk)
    return d.groupBy("report_date", "shift", "sf_id").agg(
        F.sum("dur_us").alias("covered_us"), F.count("*").alias("n_segments"))


def calibration_state_time_q(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Sweep (J5): productive / idle / off microseconds per calibration shift."""
    return calibration_state_time(t, scope, cfg)


def cycle_islands(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Islands (J8): cycles found per report-date window and machine."""
    c = cycles_in_windows(t.machines, scope=scope, machine_ids=VAPEX_VINC + VAPEX_GRINDING,
                          before=cfg.cycle_window_before, after=cfg.cycle_window_after,
                          chunk=cfg.window_chunk)
    return c.groupBy("report_date", "machine_id").agg(
        F.count("*").alias("n_cycles"),
        F.sum(F.when(F.col("theoretical_min") > cfg.cycle_min_theoretical, 1).otherwise(0)).alias("n_valid"),
        F.sum("theoretical_min").alias("sum_theoretical"),
        F.sum(F.col("operation_id")).alias("sum_operation"))


def state_sweep(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Sweep (J5), row level: every re-milling status sample of each calibration
    shift with its rotary flag, "any silo 6-10 emptying" and segment length."""
    lo, hi = REACH["cal"]
    silos = t.silos_b.filter(F.col("silo_id").between(*cfg.disinfection_silos))
    rows = status_samples(t.remill, sieve_running(), silos, scope=scope, lo=lo, hi=hi, chunk=cfg.window_chunk)
    d = scope.keep(segments(rows, t.remill, sieve_running(), "cal", scope=scope, lo=lo, hi=hi, chunk=cfg.window_chunk))
    return d.select("report_date", "shift", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_utc"),
                    "flag", "any_state", "dur_us")
