"""Shift metrics on Spark.

Work-shift analytics over irregularly sampled machine telemetry, expressed
as DataFrame plans.  Every metric is computed for *all* requested report
dates in one pass: ``report_date`` is a column, never a driver-side loop.

Layout
------
``config``      fixed domain values (zone, shift grids, caps, rates, labels)
``functions``   column expressions: time grid, formatting, status classes
``sources``     sensor-table readers and the fixture views over ``events``
``operators``   reusable building blocks (carry-in, as-of, segments, sweep,
                gated level gain, cycle islands, activity)
``plans``       the report queries, the operational calendar and the mart
``streaming``   incremental refresh of the report mart
"""

from shiftmetrics.config import DEFAULT_CONFIG, Config
from shiftmetrics.plans.scope import Scope

__all__ = ["Config", "DEFAULT_CONFIG", "Scope"]
