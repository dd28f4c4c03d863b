"""Sensor tables derived from the driver's ``events`` table.

The test data has no factory telemetry, so each sensor table is a view over
``events`` (definitions in FIXTURES.md section 2; the oracle SQL uses the
same expressions).  Time is moved forward 75 days so the data crosses the
2024-03-31 clock change.  ``event_id`` is the tie-breaker ``id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.plans.opcalendar import holidays_frame
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.tables import SensorTables

# Fixed fixture values (shared with the oracle SQL).
SHIFT_DAYS = 75
FIXTURE_HOLIDAYS = "2024-03-29,2024-04-01"


def base_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "event_type",
        (F.col("ts") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")).alias("ts"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def _flag(et, ones: tuple[str, ...], null_on_error: bool = True):
    e = F.when(F.col(et).isin(*ones), 1)
    if null_on_error:
        e = e.when(F.col(et) == "error", F.lit(None))
    return e.otherwise(0).cast("int")


def fixture_tables(spark: SparkSession, sf_dir: str) -> SensorTables:
    b = base_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    et = "event_type"
    md = b.select("ts", F.col("event_id").alias("id"),
                  _flag(et, ("click", "purchase", "view")).alias("running"),
                  _flag(et, ("purchase",)).alias("loaded"))
    screws = b.select("ts", F.col("event_id").alias("id"),
                      (F.col("user_id") % 6 + 1).cast("int").alias("sf_id"),
                      (F.col("k") % 4).alias("freq"))
    state = F.when(F.col(et) == "purchase", 1).when(F.col(et) == "view", 2)
    silos_a = b.select("ts", F.col("event_id").alias("id"),
                       (F.col("user_id") % 5 + 1).cast("int").alias("silo_id"),
                       state.otherwise(0).cast("int").alias("state"),
                       F.col("cents").alias("kg"))
    silos_b = b.select("ts", F.col("event_id").alias("id"),
                       (F.col("user_id") % 5 + 6).cast("int").alias("silo_id"),
                       state.when(F.col(et) == "error", F.lit(None)).otherwise(0)
                       .cast("int").alias("state"),
                       F.col("cents").alias("kg"))
    silos_c = b.select("ts", F.col("event_id").alias("id"),
                       (F.col("user_id") % 7 + 1).cast("int").alias("silo_id"),
                       F.col("cents").alias("kg"))
    remill = b.select("ts", F.col("event_id").alias("id"),
                      _flag(et, ("click",)).alias("m23"),
                      _flag(et, ("view",), null_on_error=False).alias("m45"))
    eid = F.col("event_id")
    counters = b.select(
        "ts", eid.alias("id"),
        F.when(eid % 9 != 0, (eid % 4000) * 3).alias("total"),
        (eid % 4000).alias("p05_1"),
        F.when(eid % 50 != 0, (eid % 3000) * 2).alias("p1_2"),
        (eid % 2500).alias("p2_3"),
        (eid * 2).alias("p3_7"))
    op = (F.when(F.col(et) == "click", 1).when(F.col(et) == "purchase", 2)
          .when(F.col(et) == "view", 3).when(F.col(et) == "signup", 4))
    mstate = (F.when(F.col(et) == "click", "Funcionamento").when(F.col(et) == "purchase", "Carga")
              .when(F.col(et) == "view", "Descarga").otherwise("Parado"))
    machines = b.select("ts", (F.col("user_id") % 9 + 1).cast("int").alias("machine_id"),
                        eid.alias("record_id"), op.cast("int").alias("operation_id"),
                        (30 + F.col("k") % 60).alias("theoretical_min"),
                        mstate.alias("state"))
    return SensorTables(md=md, screws=screws, silos_a=silos_a, silos_b=silos_b,
                        silos_c=silos_c, remill=remill, counters=counters, machines=machines,
                        holidays=holidays_frame(spark, FIXTURE_HOLIDAYS))


def fixture_scope(spark: SparkSession, sf_dir: str) -> Scope:
    """All local dates covered by the shifted events; "now" = latest event."""
    b = base_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return Scope.spanning(b.select("ts"))


_BOUND: dict[tuple[str, str, str], tuple[SensorTables, Scope]] = {}


def fixture(spark: SparkSession, sf_dir: str) -> tuple[SensorTables, Scope]:
    """Fixture tables and scope, built once per (session, directory).

    DataFrames are immutable plans, so every query of a run can share them;
    this saves re-listing the files and re-running the span aggregate.
    """
    key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), sf_dir)
    if key not in _BOUND:
        _BOUND[key] = (fixture_tables(spark, sf_dir), fixture_scope(spark, sf_dir))
    return _BOUND[key]


def bind_fixture(plan):
    """``plan(tables, scope)`` -> ``f(spark, sf_dir)`` over the fixture views."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(*fixture(spark, sf_dir))
    run.__name__ = getattr(plan, "__name__", "plan")
    run.__doc__ = plan.__doc__
    return run
