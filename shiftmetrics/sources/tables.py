"""The sensor tables and their readers.

Canonical schemas (``ts`` is a UTC instant stored as ``timestamp_ntz``;
``id`` is a per-row tie-breaker for equal timestamps):

=============  ===============================================================
``md``         ts, id, running, loaded                     (0/1, nullable)
``screws``     ts, id, sf_id, freq
``silos_a``    ts, id, silo_id, state, kg                  silos 1-5
``silos_b``    ts, id, silo_id, state, kg                  silos 6-10
``silos_c``    ts, id, silo_id, kg                         VINC silos 1-6
``remill``     ts, id, m23, m45                            rotary sieves
``counters``   ts, id, total, p05_1, p1_2, p2_3, p3_7      cumulative kg
``machines``   ts, machine_id, record_id, operation_id, theoretical_min, state
``holidays``   day
=============  ===============================================================

The reference keeps the nine disinfection machines in nine identical
tables; ``read_tables`` accepts either one ``machines`` table or the nine
per-machine tables and labels them into one (A3).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENSOR_TABLES = ("md", "screws", "silos_a", "silos_b", "silos_c", "remill", "counters", "machines")


@dataclass(frozen=True)
class SensorTables:
    md: DataFrame
    screws: DataFrame
    silos_a: DataFrame
    silos_b: DataFrame
    silos_c: DataFrame
    remill: DataFrame
    counters: DataFrame
    machines: DataFrame
    holidays: DataFrame


def union_machines(per_machine: dict[int, DataFrame]) -> DataFrame:
    """Label per-machine tables with ``machine_id`` and union them by name."""
    parts = [df.withColumn("machine_id", F.lit(i)) for i, df in sorted(per_machine.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_tables(spark: SparkSession, root: str, holidays: tuple[str, ...] = ()) -> SensorTables:
    """Read ``<root>/<table>`` Parquet datasets (optionally partitioned by date).

    Machines come from ``<root>/machines`` or, if absent, from
    ``<root>/machine_1`` .. ``machine_9``.
    """
    def rd(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    try:
        machines = rd("machines")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        machines = union_machines({i: rd(f"machine_{i}") for i in range(1, 10)})
    from shiftmetrics.plans.opcalendar import holidays_frame
    return SensorTables(
        md=rd("md"), screws=rd("screws"), silos_a=rd("silos_a"), silos_b=rd("silos_b"),
        silos_c=rd("silos_c"), remill=rd("remill"), counters=rd("counters"),
        machines=machines, holidays=holidays_frame(spark, ",".join(holidays)))
