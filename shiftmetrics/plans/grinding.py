"""Grinding and disinfection-grinding metrics (Q02-Q08, Q13-Q17).

Every function takes the sensor tables and a ``Scope`` and returns one row
per report date.  The ``*_current`` variants are shift 1 of the following day
(``Atual 00-08``), computed by the same plan on the next-day scope and keyed
back to the report date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftmetrics.config import DEFAULT_CONFIG, Config
from shiftmetrics.functions.formatting import (
    capped_percent, hours_text, percent_tenths, rate_parts, runtime_text,
)
from shiftmetrics.functions.timegrid import DAY_GRID
from shiftmetrics.operators.carry import daily_snapshot
from shiftmetrics.operators.levels import level_gain
from shiftmetrics.operators.segments import capped_shares
from shiftmetrics.plans.scope import Scope, next_day, with_dates
from shiftmetrics.sources.tables import SensorTables

DAY_COLS = ("t1_00_08", "t2_08_16", "t3_16_24")
CURRENT_COL = "atual_00_08"


def by_shift(df: DataFrame, value: str, names=DAY_COLS, agg: str = "max") -> list[Column]:
    """``MAX(value) FILTER (WHERE shift = k)`` for k = 1..3."""
    return [F.expr(f"{agg}(CASE WHEN shift = {k} THEN {value} END)").alias(n)
            for k, n in enumerate(names, start=1)]


def _current(scope: Scope) -> Scope:
    return next_day(scope)


def _first_shift(f_next: DataFrame, scope: Scope, *values: str) -> DataFrame:
    """Sums over shift 1 of the following days, by report date."""
    f = f_next.filter(F.col("shift") == 1).select(F.date_sub("report_date", 1).alias("report_date"), *values)
    return with_dates(scope, f).groupBy("report_date").agg(*[F.sum(v).alias(v) for v in values])


# --- facts per shift -----------------------------------------------------------

def md_shift_facts(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG,
                   shifts=(1, 2, 3)) -> DataFrame:
    """Running and running-while-loaded microseconds per shift (Q02 core)."""
    d = capped_shares(t.md, scope=scope, grid=DAY_GRID, cols=["running", "loaded"], cap=cfg.gap_cap,
                      lookback=cfg.carry_lookback, clamp=True, shifts=shifts, chunk=cfg.window_chunk)
    run = F.col("running") == 1
    return d.groupBy("report_date", "shift").agg(
        F.sum(F.when(run, F.col("dur_us")).otherwise(0)).alias("run_us"),
        F.sum(F.when(run & (F.col("loaded") == 1), F.col("dur_us")).otherwise(0)).alias("load_us"))


def mill_shift_facts(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG,
                     shifts=(1, 2, 3)) -> DataFrame:
    """Longest screw running time per shift in microseconds (Q03 core, E1+E2)."""
    ids = F.col("sf_id").isin(*cfg.mill_screws)
    d = capped_shares(t.screws, scope=scope, grid=DAY_GRID, entity="sf_id", cols=["freq"], cap=cfg.gap_cap,
                      lookback=cfg.carry_lookback, clamp=True, shifts=shifts, sample_filter=ids,
                      chunk=cfg.window_chunk)
    work = F.when(F.col("freq") > cfg.mill_freq_min, F.col("dur_us")).otherwise(0)
    per_sf = d.groupBy("report_date", "shift", "sf_id").agg(F.sum(work).alias("work_us"))
    return per_sf.groupBy("report_date", "shift").agg(F.max("work_us").alias("work_us"))


def silo_shift_gain(silos: DataFrame, scope: Scope, cfg: Config = DEFAULT_CONFIG, *,
                    clamp: bool = False, shifts=(1, 2, 3), carry_filter: Column | None = None,
                    sample_filter: Column | None = None) -> DataFrame:
    """kg gained while filling, per shift (Q04 core); ``clamp``: before "now" only."""
    g = level_gain(silos, scope=scope, grid=DAY_GRID, lookback=cfg.carry_lookback, chunk=cfg.window_chunk,
                   shifts=shifts, carry_filter=carry_filter, sample_filter=sample_filter)
    return g.groupBy("report_date", "shift").agg(F.sum("gain_before" if clamp else "gain").alias("kg"))


def silo_gain_facts(silos: DataFrame, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Per (date, shift, silo): kg gained, and kg gained before "now".

    Gains are per silo, so a silo filter applied to all samples equals a
    filter on these facts.  One pass serves Q04, Q05, Q07 and Q17.
    """
    g = level_gain(silos, scope=scope, grid=DAY_GRID, lookback=cfg.carry_lookback, chunk=cfg.window_chunk)
    return g.withColumnsRenamed({"gain": "kg", "gain_before": "kg_eff"})


# --- report queries ------------------------------------------------------------

def md_runtime(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q02: MD running time and load share per shift, ``05h33 (49%)``."""
    return md_runtime_from(md_shift_facts(t, scope, cfg), scope)


def md_runtime_from(f: DataFrame, scope: Scope) -> DataFrame:
    w = with_dates(scope, f).groupBy("report_date").agg(
        *by_shift(f, "run_us", [f"r{k}" for k in (1, 2, 3)]),
        *by_shift(f, "load_us", [f"l{k}" for k in (1, 2, 3)])).fillna(0)
    return w.select("report_date",
                    *[runtime_text(f"r{k}", f"l{k}").alias(DAY_COLS[k - 1]) for k in (1, 2, 3)],
                    runtime_text("r1 + r2 + r3", "l1 + l2 + l3").alias("total"))


def md_runtime_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q14: Q02 for the following day's 00-08 shift."""
    return md_current_from(md_shift_facts(t, _current(scope), cfg, shifts=(1,)), scope)


def md_current_from(f_next: DataFrame, scope: Scope) -> DataFrame:
    """From facts keyed by the following day (its shift 1 is used)."""
    w = _first_shift(f_next, scope, "run_us", "load_us").fillna(0)
    return w.select("report_date", runtime_text("run_us", "load_us").alias(CURRENT_COL))


def mill_hours(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q03: mill hours per shift (max over screws), ``05h33``."""
    return mill_hours_from(mill_shift_facts(t, scope, cfg), scope)


def mill_hours_from(f: DataFrame, scope: Scope) -> DataFrame:
    w = with_dates(scope, f).groupBy("report_date").agg(*by_shift(f, "work_us", ["w1", "w2", "w3"])).fillna(0)
    return w.select("report_date", *[hours_text(f"w{k}").alias(DAY_COLS[k - 1]) for k in (1, 2, 3)],
                    hours_text("w1 + w2 + w3").alias("total"))


def mill_hours_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q15: Q03 for the following day's 00-08 shift."""
    return mill_current_from(mill_shift_facts(t, _current(scope), cfg, shifts=(1,)), scope)


def mill_current_from(f_next: DataFrame, scope: Scope) -> DataFrame:
    w = _first_shift(f_next, scope, "work_us").fillna(0)
    return w.select("report_date", hours_text("work_us").alias(CURRENT_COL))


def kg_wide_from(f: DataFrame, scope: Scope, value: str = "kg") -> DataFrame:
    """T1/T2/T3/TOTAL kg from per-shift facts."""
    w = with_dates(scope, f).groupBy("report_date").agg(*by_shift(f, value))
    cols = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in DAY_COLS]
    w = w.select("report_date", *cols)
    return w.withColumn("total", F.col(DAY_COLS[0]) + F.col(DAY_COLS[1]) + F.col(DAY_COLS[2]))


def kg_current_from(f_next: DataFrame, scope: Scope, value: str = "kg") -> DataFrame:
    w = _first_shift(f_next, scope, value)
    return w.select("report_date", F.coalesce(F.col(value), F.lit(0)).alias(CURRENT_COL))


def silo_kg_grinding(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q04: kg into silos 1-5 per shift (no silo filter, as the reference)."""
    return kg_wide_from(silo_shift_gain(t.silos_a, scope, cfg), scope)


def silo_kg_disinfection(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q07: kg into silos 6-10 per shift (no silo filter, as the reference)."""
    return kg_wide_from(silo_shift_gain(t.silos_b, scope, cfg), scope)


def silo_kg_grinding_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q16: kg silos 1-5, following day 00-08 (silo filter on the carry-in only)."""
    ids = F.col("silo_id").between(*cfg.grinding_silos)
    f = silo_shift_gain(t.silos_a, _current(scope), cfg, shifts=(1,), carry_filter=ids)
    return kg_current_from(f, scope)


def silo_kg_disinfection_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q17: kg silos 6-10, following day 00-08 (silo filter on both inputs)."""
    ids = F.col("silo_id").between(*cfg.disinfection_silos)
    f = silo_shift_gain(t.silos_b, _current(scope), cfg, shifts=(1,), carry_filter=ids, sample_filter=ids)
    return kg_current_from(f, scope)


def grinding_oee(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q05: grinding OEE % per shift and day vs the nominal rate, capped at 100.

    kg (clamped to "now") and mill time are joined on (date, shift); the day
    value is a ratio of sums, not a mean of shift ratios (E9, J3).
    """
    kg = silo_shift_gain(t.silos_a, scope, cfg, clamp=True)
    return grinding_oee_from(kg, mill_shift_facts(t, scope, cfg), scope, cfg)


def grinding_oee_from(kg: DataFrame, work: DataFrame, scope: Scope, cfg: Config = DEFAULT_CONFIG,
                      kg_col: str = "kg") -> DataFrame:
    both = kg.select("report_date", "shift", F.col(kg_col).alias("kg")).unionByName(
        work.select("report_date", "shift", "work_us"), allowMissingColumns=True)
    w = with_dates(scope, both).groupBy("report_date").agg(
        *by_shift(both, "kg", ("kg1", "kg2", "kg3"), "sum"), *by_shift(both, "work_us", ("us1", "us2", "us3"), "sum"),
        F.sum("kg").alias("kg"), F.sum("work_us").alias("work_us")).fillna(0)

    def oee(kg_c: str, us: str) -> Column:
        return capped_percent(percent_tenths(*rate_parts(F.col(kg_c), F.col(us), cfg.grinding_rate_kg_h)))

    return w.select("report_date", *[oee(f"kg{k}", f"us{k}").alias(c) for k, c in enumerate(DAY_COLS, start=1)],
                    oee("kg", "work_us").alias("total"))


def _silo_total(silos: DataFrame, scope: Scope, cfg: Config, ids: tuple[int, int]) -> DataFrame:
    s = silos.filter(F.col("silo_id").between(*ids))
    snap = daily_snapshot(s, scope=scope, entity="silo_id", value="kg", at=cfg.snapshot_at)
    return with_dates(scope, snap).groupBy("report_date").agg(F.sum("v").alias("total"))


def silo_total_8h_grinding(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q06: sum of the latest weights of silos 1-5 at D+1 08:00 (NULL if none)."""
    return _silo_total(t.silos_a, scope, cfg, cfg.grinding_silos)


def silo_total_8h_disinfection(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q08: sum of the latest weights of silos 6-10 at D+1 08:00 (NULL if none)."""
    return _silo_total(t.silos_b, scope, cfg, cfg.disinfection_silos)


# Fixed value: column of each VINC silo, in silo order.
VINC_COLS = ("silo_1_3a7_cs", "silo_2_2a3_cs", "silo_3_1a2_cs", "silo_4_05a1_cs",
             "silo_5_1a2_vinc", "silo_6_05a1_vinc")


def silo_snapshot_vinc(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q13: latest weight of each VINC silo 1-6 at D+1 08:05, 0 if missing."""
    s = t.silos_c.filter(F.col("silo_id").between(*cfg.vinc_silos))
    snap = daily_snapshot(s, scope=scope, entity="silo_id", value="kg", at=cfg.vinc_snapshot_at)
    w = with_dates(scope, snap).groupBy("report_date").agg(
        *[F.max(F.when(F.col("silo_id") == i, F.col("v"))).alias(c)
          for i, c in enumerate(VINC_COLS, start=1)])
    return w.select("report_date", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in VINC_COLS])
