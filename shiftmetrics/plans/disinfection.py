"""Disinfection cycle counts (Q10, Q12, Q20, Q21).

Counts cycles with theoretical time above the threshold by the shift (local
wall clock) of their *scheduled* end.  VINC uses machines 1-4, grinding
5-9; the rows are labelled ``VAPEX n`` and a ``TOTAL`` row is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftmetrics.config import DEFAULT_CONFIG, VAPEX_GRINDING, VAPEX_TOTAL_LABEL, VAPEX_VINC, Config
from shiftmetrics.operators.cycles import cycles_in_windows
from shiftmetrics.plans.scope import Scope, with_dates
from shiftmetrics.sources.tables import SensorTables

COLS = ("t1", "t2", "t3")
CURRENT_COL = "atual_00_08"


def day_cycles(t: SensorTables, scope: Scope, ids: tuple[int, ...],
               cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Cycles found in each report date's window [D - 12 h, D + 36 h)."""
    return cycles_in_windows(t.machines, scope=scope, machine_ids=ids,
                             before=cfg.cycle_window_before, after=cfg.cycle_window_after,
                             chunk=cfg.window_chunk)


def current_cycles(t: SensorTables, scope: Scope, ids: tuple[int, ...],
                   cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Cycles found in each following day's window [D+1 - 12 h, D+1 + 20 h)."""
    return cycles_in_windows(t.machines, scope=scope, machine_ids=ids,
                             before=cfg.cycle_window_before, after=cfg.current_cycle_window_after,
                             day_offset=1, chunk=cfg.window_chunk)


def _rows(counts: list[list[str]], ids: tuple[int, ...], names: tuple[str, ...]) -> F.Column:
    """One row per machine and a TOTAL row, from the columns of counts of one report date ([machine][shift])."""
    def row(label: str, values: list) -> F.Column:
        return F.struct(F.lit(label).alias("vapex"), *[v.alias(n) for v, n in zip(values, names, strict=True)])

    rows = [row(f"VAPEX {i}", [F.col(c) for c in cs]) for i, cs in zip(ids, counts, strict=True)]
    total = [sum((F.col(cs[k]) for cs in counts[1:]), F.col(counts[0][k])) for k in range(len(names))]
    return F.inline(F.array(*rows, row(VAPEX_TOTAL_LABEL, total)))


def disinfections_from(cycles: DataFrame, scope: Scope, ids: tuple[int, ...],
                       cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Cycles per report date, machine and day shift of the scheduled end: one aggregation by date."""
    c = cycles.filter((F.col("theoretical_min") > cfg.cycle_min_theoretical)
                      & (F.col("scheduled_end_local").cast("date") == F.col("w")))
    c = c.select("report_date", "machine_id", ((F.hour("scheduled_end_local") / 8).cast("int") + 1).alias("shift"))
    names = [[f"n_{i}_{k}" for k in (1, 2, 3)] for i in ids]
    wide = with_dates(scope, c).groupBy("report_date").agg(
        *[F.count_if((F.col("machine_id") == i) & (F.col("shift") == k)).alias(f"n_{i}_{k}") for i in ids for k in (1, 2, 3)])
    out = wide.select("report_date", _rows(names, ids, COLS))
    return out.withColumn("total", F.col("t1") + F.col("t2") + F.col("t3"))


def disinfections_vinc(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q10: VINC disinfection cycles per VAPEX 1-4 and shift, with a TOTAL row."""
    return disinfections_from(day_cycles(t, scope, VAPEX_VINC, cfg), scope, VAPEX_VINC, cfg)


def disinfections_grinding(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q12: grinding disinfection cycles per VAPEX 5-9 and shift, with a TOTAL row."""
    return disinfections_from(day_cycles(t, scope, VAPEX_GRINDING, cfg), scope, VAPEX_GRINDING, cfg)


def current_from(cycles: DataFrame, scope: Scope, ids: tuple[int, ...],
                 cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    start = F.col("w").cast("timestamp_ntz")
    c = cycles.filter((F.col("theoretical_min") > cfg.cycle_min_theoretical)
                      & (F.col("scheduled_end_local") >= start)
                      & (F.col("scheduled_end_local") < start + F.expr("INTERVAL 8 HOURS")))
    wide = with_dates(scope, c.select("report_date", "machine_id")).groupBy("report_date").agg(
        *[F.count_if(F.col("machine_id") == i).alias(f"n_{i}") for i in ids])
    return wide.select("report_date", _rows([[f"n_{i}"] for i in ids], ids, (CURRENT_COL,)))


def disinfections_grinding_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q20: grinding cycles whose scheduled end falls in the following day's 00-08."""
    return current_from(current_cycles(t, scope, VAPEX_GRINDING, cfg), scope, VAPEX_GRINDING, cfg)


def disinfections_vinc_current(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q21: VINC cycles whose scheduled end falls in the following day's 00-08."""
    return current_from(current_cycles(t, scope, VAPEX_VINC, cfg), scope, VAPEX_VINC, cfg)
