"""Plan guards: no nested-loop or Cartesian joins, no Python UDFs, and the
scope's literal time bounds reach the Parquet scan."""

import re
import tempfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from golden import tables
from shiftmetrics.plans import grinding
from shiftmetrics.plans.scope import DATE_PARTITION, Scope
from shiftmetrics.registry import ALL_QUERIES
from shiftmetrics.sources.fixtures import fixture_tables
from shiftmetrics.sources.prior import build_prior, cutoff_for, with_prior

SF = "/root/testdata/sf0.001"
BANNED = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ALL_QUERIES))
def test_no_banned_operators(spark, name):
    plan = physical(entry.queries()[name](spark, SF))
    assert not [b for b in BANNED if b in plan]


def test_time_bounds_are_pushed_to_parquet(spark):
    base = datetime(2024, 3, 1)
    rows = [(base + timedelta(minutes=7 * i), i % 2, 0) for i in range(2000)]
    path = tempfile.mkdtemp(prefix="md-") + "/md"
    tables(spark, md=rows).md.write.parquet(path)
    md = spark.read.parquet(path)
    t = tables(spark)
    t = type(t)(**{**t.__dict__, "md": md})
    s = Scope.for_range(spark, date(2024, 3, 4), date(2024, 3, 5), as_of=datetime(2099, 1, 1))
    df = grinding.md_runtime(t, s)
    df.collect()
    scans = [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines()
             if "FileScan parquet" in ln]
    assert scans and all("GreaterThanOrEqual(ts" in ln and "LessThanOrEqual(ts" in ln for ln in scans), scans


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The fixture tables as stored Parquet tables, so that bounds on ``ts`` can reach the scans."""
    root = tmp_path_factory.mktemp("tables")
    t = fixture_tables(spark, SF)
    read = {}
    for name in ("md", "screws", "silos_a", "silos_b", "silos_c", "remill", "counters", "machines"):
        getattr(t, name).write.parquet(f"{root}/{name}")
        read[name] = spark.read.parquet(f"{root}/{name}")
    return type(t)(**{**t.__dict__, **read}), str(root)


@pytest.mark.parametrize("name", sorted(ALL_QUERIES))
def test_every_sample_scan_is_bounded(spark, stored, name):
    """One report date, with a stored prior: every scan of a sample table has a lower and an upper bound,
    but for the as-of inputs, whose history the prior stands for (a lower bound)."""
    t, root = stored
    day = date(2024, 4, 2)
    cut = cutoff_for(day)
    t = with_prior(t, {k: spark.createDataFrame(v.collect(), v.schema) for k, v in build_prior(t, cut).items()}, cut)
    scope = Scope.for_range(spark, day, day, as_of=datetime(2099, 1, 1))
    mart = {"materialized": False} if name == "report_cells" else {}
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = physical(ALL_QUERIES[name](t, scope, **mart))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        assert "ts >=" in line or "GreaterThanOrEqual(ts" in line, line
        if "/counters" not in line and "/silos" not in line:
            assert "ts <=" in line or "LessThan" in line, line


def test_date_partitions_are_pruned(spark, tmp_path):
    """Tables partitioned by date: every scan of a one-day run names the folders it lists, at most three for bounded inputs."""
    t = fixture_tables(spark, SF)
    read = {}
    for name in ("md", "screws", "silos_a", "silos_b", "silos_c", "remill", "counters", "machines"):
        df = getattr(t, name).withColumn(DATE_PARTITION, F.col("ts").cast("date"))
        df.repartition(DATE_PARTITION).write.partitionBy(DATE_PARTITION).parquet(f"{tmp_path}/{name}")
        read[name] = spark.read.parquet(f"{tmp_path}/{name}")
    parted = type(t)(**{**t.__dict__, **read})
    day = date(2024, 4, 2)
    cut = cutoff_for(day)
    parted = with_prior(parted, {k: spark.createDataFrame(v.collect(), v.schema) for k, v in build_prior(parted, cut).items()}, cut)
    scope = Scope.for_range(spark, day, day, as_of=datetime(2099, 1, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        for name, plan in ALL_QUERIES.items():
            text = physical(plan(parted, scope, **({"materialized": False} if name == "report_cells" else {})))
            scans = [line for line in text.splitlines() if "FileScan parquet" in line]
            assert scans, name
            for line in scans:
                filters = line[line.index("PartitionFilters"):line.index("PushedFilters")]
                low = [date.fromisoformat(x) for x in re.findall(r">= (\d{4}-\d\d-\d\d)\)", filters)]
                high = [date.fromisoformat(x) for x in re.findall(r"<= (\d{4}-\d\d-\d\d)\)", filters)]
                assert low, (name, line)
                if "/counters" not in line and "/silos" not in line:
                    assert high and (min(high) - max(low)).days < 3, (name, line)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    full, part = (sorted(map(str, grinding.grinding_oee(x, scope).collect())) for x in (t, parted))
    assert full == part


@pytest.mark.parametrize("name, scans, exchanges", [
    ("silo_kg_grinding", 1, 4), ("silo_kg_grinding_current", 1, 4), ("carry_in_latest", 1, 2), ("cycle_islands", 1, 4),
    ("calibration_oee", 4, 8), ("granulate_by_product", 1, 3), ("disinfections_vinc", 1, 4)])
def test_each_table_is_read_once(spark, name, scans, exchanges):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(entry.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") <= scans
    assert plan.count("Exchange hashpartitioning") <= exchanges
