"""Report activity.

A date had activity when any of: an MD running/loaded flag between D 08:00
and D+1 08:00; a calibration counter step of at least the minimum between
D 06:00 and D+1 06:00 (closed); a disinfection machine in an active state
between D 08:00 and D+1 08:00.  Each source yields a set of dates; no
correlated EXISTS per date.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftmetrics.config import ACTIVE_MACHINE_STATES, DEFAULT_CONFIG, Config
from shiftmetrics.functions.timegrid import interval, to_local
from shiftmetrics.operators.activity import largest_steps
from shiftmetrics.plans.scope import Scope, with_dates
from shiftmetrics.sources.tables import SensorTables


def _flag_days(df: DataFrame, cond, scope: Scope, cfg: Config, name: str) -> DataFrame:
    day = (to_local(F.col("ts"), scope.tz) - interval(cfg.activity_day_start)).cast("date")
    rows = scope.clip(df, -cfg.activity_day_start, cfg.activity_day_start + timedelta(days=1)).filter(cond)
    return rows.select(day.alias("report_date"), F.lit(True).alias(name))


def report_activity(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """Q01: ``has_production`` per report date, with its three sources and the
    largest counter step of the day."""
    md = _flag_days(t.md, (F.coalesce("running", F.lit(0)) == 1) | (F.coalesce("loaded", F.lit(0)) == 1),
                    scope, cfg, "md_active")
    vapex = _flag_days(t.machines, F.col("state").isin(*ACTIVE_MACHINE_STATES), scope, cfg,
                       "vapex_active")
    steps = largest_steps(t.counters, "total", scope=scope, day_start=cfg.activity_counter_start,
                          chunk=cfg.window_chunk)
    facts = md.unionByName(vapex, allowMissingColumns=True).unionByName(steps, allowMissingColumns=True)
    out = with_dates(scope, facts).groupBy("report_date").agg(
        *[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("md_active", "vapex_active")],
        F.coalesce(F.max("step") >= F.lit(cfg.activity_min_kg), F.lit(False)).alias("counter_active"),
        F.max("step").cast("double").alias("max_counter_step"))
    return out.select("report_date", "md_active", "counter_active", "vapex_active", "max_counter_step",
                      (F.col("md_active") | F.col("counter_active") | F.col("vapex_active")).alias("has_production"))
