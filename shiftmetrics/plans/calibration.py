"""Calibration metrics (Q09, Q11, Q18, Q19).

Produced kg comes from cumulative counters read as-of the shift boundaries
(``<=``, unbounded lookback, latest row even when its value is NULL, resets
clamped to 0).  Time is split by the rotary-sieve status samples and the
state of the disinfection silos 6-10 at each sample (sweep).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftmetrics.config import (
    CAL_INDICATORS, DEFAULT_CONFIG, IND_AVAILABILITY, IND_IDLE, IND_OEE, IND_OFF,
    IND_PERFORMANCE, PRODUCT_TOTAL_LABEL, PRODUCTS, Config,
)
from shiftmetrics.functions.formatting import (
    US_PER_S, capped_percent, milli, percent_tenths, rate_parts, round_div,
)
from shiftmetrics.functions.timegrid import CAL_GRID, DAY_GRID, Grid, cell_report_date, cell_shift_of
from shiftmetrics.operators.carry import asof_at_boundaries, scope_cell_bounds
from shiftmetrics.operators.sweep import CLASSES, state_time, status_samples
from shiftmetrics.plans.scope import Scope, with_dates
from shiftmetrics.sources.tables import SensorTables

CAL_COLS = ("t1_22_06", "t2_06_14", "t3_14_22")
CURRENT_COL = "atual_00_08"


def counter_gain(counters: DataFrame, cols: list[str], scope: Scope, grid: Grid,
                 first_cell_offset: int, last_cell_offset: int) -> DataFrame:
    """Counter increase per shift cell: ``greatest(v(end) - v(start), 0)``, a
    missing value counting as 0 (J2, D5).  Returns ``report_date, shift, *cols``."""
    lo, hi = scope_cell_bounds(scope, first_cell_offset, last_cell_offset + 1)
    asof = asof_at_boundaries(counters, scope=scope, grid=grid, cols=cols,
                              boundary_lo=lo, boundary_hi=hi)
    # Boundaries follow each other without gaps, three a day: the one before is the shift's start.
    before = Window.orderBy("b")
    g = asof.select("b", "v", F.when(F.lag("b").over(before) == F.col("b") - 1, F.lag("v").over(before)).alias("vs"))
    g = g.filter(F.col("b") > lo).withColumn("cell", F.col("b") - 1)
    gains = [F.greatest(F.coalesce(F.col(f"v.{c}"), F.lit(0)) - F.coalesce(F.col(f"vs.{c}"), F.lit(0)),
                        F.lit(0)).alias(c) for c in cols]
    return g.select(cell_report_date(F.col("cell")).alias("report_date"),
                    cell_shift_of(F.col("cell")).alias("shift"), *gains)


def _share(total: Column, grand: Column) -> Column:
    """``COALESCE(ROUND(100 * total / NULLIF(grand, 0)), 0)``."""
    part, whole = milli(total).cast("decimal(30,0)"), milli(grand).cast("decimal(30,0)")
    share = F.call_function("div", 200 * part + whole, 2 * whole).cast("double")
    return F.when(whole > 0, share).otherwise(F.lit(0.0))


COUNTER_COLS = ["total", *[c for _, c in PRODUCTS]]


def calibration_counter_gain(t: SensorTables, scope: Scope) -> DataFrame:
    """Counter gains per calibration shift of the scope (total and products)."""
    return scope.keep(counter_gain(t.counters, COUNTER_COLS, scope, CAL_GRID, 0, 2))


def next_day_counter_gain(t: SensorTables, scope: Scope) -> DataFrame:
    """Counter gains per day-grid shift of the following days (keyed D + 1)."""
    return counter_gain(t.counters, COUNTER_COLS, scope, DAY_GRID, 3, 3)


def granulate_by_product(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q09: kg per product and calibration shift, a Total row and share %."""
    cols = [c for _, c in PRODUCTS]
    return granulate_from(scope.keep(counter_gain(t.counters, cols, scope, CAL_GRID, 0, 2)), scope)


def granulate_from(gain: DataFrame, scope: Scope) -> DataFrame:
    """One aggregation by date; the products' rows, the Total row and the shares come from its columns."""
    names = [c for _, c in PRODUCTS]
    wide = with_dates(scope, gain).groupBy("report_date").agg(
        *[F.coalesce(F.sum(F.when(F.col("shift") == k, F.col(c))), F.lit(0)).alias(f"{c}_{k}") for c in names for k in (1, 2, 3)])
    by_product = {c: [F.col(f"{c}_{k}") for k in (1, 2, 3)] for c in names}
    total = [sum((by_product[c][k] for c in names[1:]), by_product[names[0]][k]) for k in range(3)]
    grand = total[0] + total[1] + total[2]

    def row(label: str, kg: list[Column], share: Column) -> Column:
        cells = [*kg, kg[0] + kg[1] + kg[2]]
        return F.struct(F.lit(label).alias("produto"), *[F.round(v, 0).cast("long").alias(n) for v, n in zip(cells, (*CAL_COLS, "total_kg"))],
                        share.alias("percentagem"))

    rows = [row(label, by_product[c], _share(by_product[c][0] + by_product[c][1] + by_product[c][2], grand)) for label, c in PRODUCTS]
    return wide.select("report_date", F.inline(F.array(*rows, row(PRODUCT_TOTAL_LABEL, total, F.lit(None).cast("double")))))


def granulate_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q18: kg per product in the following day's 00-08 shift, plus Total."""
    cols = [c for _, c in PRODUCTS]
    return granulate_current_from(counter_gain(t.counters, cols, scope, DAY_GRID, 3, 3), scope)


def granulate_current_from(gain: DataFrame, scope: Scope) -> DataFrame:
    names = [c for _, c in PRODUCTS]
    gain = gain.filter(F.col("shift") == 1).select(F.date_sub("report_date", 1).alias("report_date"), *names)
    wide = with_dates(scope, gain).groupBy("report_date").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])

    def row(label: str, kg: Column) -> Column:
        return F.struct(F.lit(label).alias("produto"), F.round(kg, 0).cast("long").alias(CURRENT_COL))

    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return wide.select("report_date", F.inline(F.array(*[row(label, F.col(c)) for label, c in PRODUCTS], row(PRODUCT_TOTAL_LABEL, total))))


# --- calibration OEE --------------------------------------------------------------

#: How far the sweep reaches before the first and after the last local midnight, by grid: Q11's shifts, Q19's next 00-08, both.
REACH = {
    "cal": (timedelta(hours=2), timedelta(hours=22)),
    "day": (timedelta(hours=-24), timedelta(hours=32)),
    "both": (timedelta(hours=2), timedelta(hours=32)),
}


def sieve_running() -> Column:
    return (F.coalesce(F.col("m23"), F.lit(0)) == 1) | (F.coalesce(F.col("m45"), F.lit(0)) == 1)


def sieve_time(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG, reach: str = "both") -> DataFrame:
    """The sweep's merged records, a few an hour: one stream of events for both grids (Q11, Q19)."""
    silos = t.silos_b.filter(F.col("silo_id").between(*cfg.disinfection_silos))
    lo, hi = REACH[reach]
    samples = status_samples(t.remill, sieve_running(), silos, scope=scope, lo=lo, hi=hi, chunk=cfg.window_chunk)
    return state_time(samples, scope)


def sieve_facts(records: DataFrame, name: str, day_offset: int = 0) -> DataFrame:
    """``report_date, shift, prod_us, idle_us, off_us`` of grid ``name``, not yet summed."""
    date = cell_report_date(F.col(name))
    return records.select(F.date_sub(date, day_offset).alias("report_date"), cell_shift_of(F.col(name)).alias("shift"),
                          *[F.col(f"{name}_{c}").alias(f"{c}_us") for c in CLASSES])


def calibration_state_time(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Productive / idle-without-granulate / section-off microseconds per calibration shift (zero without samples)."""
    facts = scope.keep(sieve_facts(sieve_time(t, scope, cfg, "cal"), "cal"))
    shifts = scope.dates.select("report_date", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("shift"))
    return facts.unionByName(shifts, allowMissingColumns=True).groupBy("report_date", "shift").agg(
        *[F.coalesce(F.sum(f"{c}_us"), F.lit(0)).alias(f"{c}_us") for c in CLASSES])


def _kpis(kg: Column, prod_us: Column, idle_us: Column, planned: float, rate: float):
    """Performance, availability and uncapped OEE (J4) in tenths of a per cent, exact."""
    made, possible = rate_parts(kg, prod_us, rate)
    planned_us = F.lit(round(planned * US_PER_S)).cast("decimal(18,0)")
    worked = F.greatest(planned_us - idle_us.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    oee = percent_tenths(made.cast("decimal(26,0)") * worked.cast("decimal(12,0)"),
                         possible.cast("decimal(26,0)") * planned_us.cast("decimal(12,0)"))
    return percent_tenths(made, possible), percent_tenths(worked, planned_us), oee


def _cap1(tenths: Column) -> Column:
    return capped_percent(tenths)


def _secs(us: str) -> Column:
    return round_div(us, US_PER_S).cast("double")


def calibration_oee(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q11: Performance / Availability / OEE / idle / off, per calibration shift and day."""
    kg = counter_gain(t.counters, ["total"], scope, CAL_GRID, 0, 2)
    return calibration_oee_from(sieve_time(t, scope, cfg, "cal"), kg, scope, cfg)


def calibration_oee_from(records: DataFrame, kg: DataFrame, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    facts = sieve_facts(records, "cal").unionByName(kg.select("report_date", "shift", "total"), allowMissingColumns=True)
    values = {"total": "kg", "prod_us": "prod", "idle_us": "idle_us", "off_us": "off_us"}
    wide = with_dates(scope, facts).groupBy("report_date").agg(
        *[F.coalesce(F.sum(F.when(F.col("shift") == k, F.col(c))), F.lit(0)).alias(f"{n}{k}") for c, n in values.items() for k in (1, 2, 3)])
    kpis = {k: _kpis(F.col(f"kg{k}"), F.col(f"prod{k}"), F.col(f"idle_us{k}"), cfg.planned_shift_s, cfg.calibration_rate_kg_h)
            for k in (1, 2, 3)}
    wide = wide.select("report_date", *[f"{c}{k}" for c in ("idle_us", "off_us") for k in (1, 2, 3)],
                       *[v.alias(f"{c}{k}") for k in (1, 2, 3) for c, v in zip(("perf", "disp", "oee"), kpis[k])],
                       *[(F.col(f"{n}1") + F.col(f"{n}2") + F.col(f"{n}3")).alias(d)
                         for n, d in (("kg", "kg_day"), ("prod", "prod_day"), ("idle_us", "idle_day"), ("off_us", "off_day"))])
    perf_d, disp_d, oee_d = _kpis(F.col("kg_day"), F.col("prod_day"), F.col("idle_day"),
                                  3 * cfg.planned_shift_s, cfg.calibration_rate_kg_h)
    names = ("indicador", *CAL_COLS, "dia")

    def row(label: str, cells: list[Column]) -> Column:
        return F.struct(*[c.alias(n) for c, n in zip([F.lit(label), *cells], names)])

    rows = F.array(
        row(IND_PERFORMANCE, [_cap1(F.col(f"perf{k}")) for k in (1, 2, 3)] + [_cap1(perf_d)]),
        row(IND_AVAILABILITY, [_cap1(F.col(f"disp{k}")) for k in (1, 2, 3)] + [_cap1(disp_d)]),
        row(IND_OEE, [_cap1(F.col(f"oee{k}")) for k in (1, 2, 3)] + [_cap1(oee_d)]),
        row(IND_IDLE, [_secs(f"idle_us{k}") for k in (1, 2, 3)] + [_secs("idle_day")]),
        row(IND_OFF, [_secs(f"off_us{k}") for k in (1, 2, 3)] + [_secs("off_day")]),
    )
    return wide.select("report_date", F.inline(rows))


def calibration_oee_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q19: the Q11 indicators for the following day's 00-08 shift."""
    kg = counter_gain(t.counters, ["total"], scope, DAY_GRID, 3, 3)
    return calibration_oee_current_from(sieve_time(t, scope, cfg, "day"), kg, scope, cfg)


def calibration_oee_current_from(records: DataFrame, kg: DataFrame, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    kg = kg.select(F.date_sub("report_date", 1).alias("report_date"), "shift", "total")
    facts = sieve_facts(records, "day", day_offset=1).unionByName(kg, allowMissingColumns=True).filter(F.col("shift") == 1)
    f = with_dates(scope, facts).groupBy("report_date").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "prod_us", "idle_us", "off_us")])
    perf, disp, oee = _kpis(F.col("total"), F.col("prod_us"), F.col("idle_us"),
                            cfg.planned_shift_s, cfg.calibration_rate_kg_h)

    def row(label: str, v: Column) -> Column:
        return F.struct(F.lit(label).alias("indicador"), v.alias(CURRENT_COL))

    rows = F.array(row(IND_PERFORMANCE, _cap1(perf)), row(IND_AVAILABILITY, _cap1(disp)),
                   row(IND_OEE, _cap1(oee)), row(IND_IDLE, _secs("idle_us")),
                   row(IND_OFF, _secs("off_us")))
    return f.select("report_date", F.inline(rows))


__all__ = ["granulate_by_product", "granulate_current", "calibration_oee",
           "calibration_oee_current", "calibration_state_time", "counter_gain", "CAL_INDICATORS"]
