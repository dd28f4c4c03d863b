"""Readers: nine per-machine tables read as one labelled table (A3); mart contract (K7)."""

from datetime import date

from golden import at, scope, tables
from shiftmetrics.plans import disinfection
from shiftmetrics.plans.report import missing_blocks
from shiftmetrics.sources.tables import read_tables

D = date(2024, 3, 5)


def test_nine_machine_tables(spark, tmp_path):
    root = str(tmp_path)
    t = tables(spark, md=[(at(D, 8), 1, 1)])
    for name in ("md", "screws", "silos_a", "silos_b", "silos_c", "remill", "counters"):
        getattr(t, name).write.parquet(f"{root}/{name}")
    for i in range(1, 10):
        spark.createDataFrame(
            [(at(D, 10), i * 10, 1, 50, "Carga"), (at(D, 11), i * 10 + 1, 2, 50, "Carga")],
            "ts timestamp_ntz, record_id long, operation_id int, theoretical_min int, state string",
        ).write.parquet(f"{root}/machine_{i}")
    rt = read_tables(spark, root, holidays=("2024-03-29",))
    assert sorted(r["machine_id"] for r in rt.machines.select("machine_id").distinct().collect()) == list(range(1, 10))
    d = disinfection.disinfections_grinding(rt, scope(spark, D))
    assert {r["vapex"]: r["t2"] for r in d.collect()} == {
        "VAPEX 5": 2, "VAPEX 6": 2, "VAPEX 7": 2, "VAPEX 8": 2, "VAPEX 9": 2, "TOTAL": 10}


def test_missing_blocks(spark):
    cells = spark.createDataFrame([(D, "a"), (D, "b"), (date(2024, 3, 6), "a")],
                                  "report_date date, block string")
    got = [r["report_date"] for r in missing_blocks(cells, expected_blocks=2).collect()]
    assert got == [date(2024, 3, 6)]
