"""Hand-made sensor tables for golden micro-cases."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.tables import SensorTables

SCHEMAS = {
    "md": "ts timestamp_ntz, id long, running int, loaded int",
    "screws": "ts timestamp_ntz, id long, sf_id int, freq double",
    "silos_a": "ts timestamp_ntz, id long, silo_id int, state int, kg double",
    "silos_b": "ts timestamp_ntz, id long, silo_id int, state int, kg double",
    "silos_c": "ts timestamp_ntz, id long, silo_id int, kg double",
    "remill": "ts timestamp_ntz, id long, m23 int, m45 int",
    "counters": "ts timestamp_ntz, id long, total double, p05_1 double, p1_2 double, p2_3 double, p3_7 double",
    "machines": "ts timestamp_ntz, machine_id int, record_id long, operation_id int, theoretical_min int, state string",
    "holidays": "day date",
}


def tables(spark, **rows) -> SensorTables:
    """Tables from lists of tuples; ``id`` columns are filled in when omitted."""
    dfs = {}
    for name, schema in SCHEMAS.items():
        data = rows.get(name, [])
        ncols = len(schema.split(","))
        if data and name not in ("machines", "holidays") and len(data[0]) == ncols - 1:
            data = [(r[0], i + 1, *r[1:]) for i, r in enumerate(data)]
        dfs[name] = spark.createDataFrame(data, schema)
    return SensorTables(**dfs)


def scope(spark, first: date, last: date | None = None, as_of: datetime | None = None) -> Scope:
    return Scope.for_range(spark, first, last or first, as_of=as_of or datetime(2099, 1, 1))


def at(d: date, h: int = 0, m: int = 0, s: int = 0, us: int = 0) -> datetime:
    """UTC instant; in winter 2024 Lisbon local time equals UTC."""
    return datetime(d.year, d.month, d.day) + timedelta(hours=h, minutes=m, seconds=s, microseconds=us)


def one(df, **where):
    rows = df.collect()
    for k, v in where.items():
        rows = [r for r in rows if r[k] == v]
    assert len(rows) == 1, rows
    return rows[0]
