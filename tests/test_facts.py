"""The store of mart facts: what is kept, what late rows take out, and that nothing else is computed."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from golden import at, tables
from shiftmetrics.config import DEFAULT_CONFIG
from shiftmetrics.plans import facts
from shiftmetrics.plans.facts import FACTS, FactStore, final_at
from shiftmetrics.plans.report import read_report, report_cells
from shiftmetrics.plans.run import backfill
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.tables import SENSOR_TABLES
from shiftmetrics.streaming import refresh_on_arrival
from shiftmetrics.streaming.refresh import affected_dates

D = date(2024, 3, 5)
FIRST, LAST = date(2024, 3, 4), date(2024, 3, 11)
LATER = datetime(2024, 4, 1)


def sensor_tables(spark, **more):
    days = [FIRST + timedelta(days=k) for k in range(9)]
    rows = {
        "md": [x for d in days for x in [(at(d, 8), 1, 1), (at(d, 8, 1), 1, 0), (at(d, 23, 59, 30), 1, 1), (at(d, 2), 0, 0)]],
        "screws": [x for d in days for x in [(at(d, 7, 59), 1, 5.0), (at(d, 8, 1), 2, 5.0), (at(d, 8, 2), 2, 0.0)]],
        "silos_a": [x for d in days for x in [(at(d, 7), 1, 1, 10.0), (at(d, 9), 1, 1, 40.0), (at(d, 1), 2, 1, 9.0)]],
        "silos_b": [x for d in days for x in [(at(d, 6), 6, 2, 10.0), (at(d, 6, 30), 6, 0, 4.0), (at(d, 22, 30), 7, 1, 44.0)]],
        "silos_c": [(at(d, 5), 3, 10.0 + k) for k, d in enumerate(days)],
        "remill": [x for d in days for x in [(at(d, 6), 1, 0), (at(d, 6, 20), 0, 1), (at(d, 7), 0, 0), (at(d, 21, 50), 1, 1), (at(d, 23), 0, 0)]],
        "counters": [(at(d, 4), 100.0 * k, 10.0 * k, 20.0 * k, 30.0 * k, 40.0 * k) for k, d in enumerate(days)],
        "machines": [(at(d, 3), 1 + k % 9, k, 3, 120, "Carga") for k, d in enumerate(days)],
    }
    return tables(spark, **(rows | more))


def found(df):
    return sorted(map(str, df.collect()))


def all_dates(f, first=FIRST, last=LAST):
    return {first + timedelta(days=k) for k in range((last - first).days + 1 + f.ahead)}


def unreadable(t, but=()):
    """Tables that fail the job that reads a row of them."""
    def fail(df):
        return df.withColumn("ts", F.when(F.col("ts").isNotNull(), F.raise_error(F.lit("read"))).cast("timestamp_ntz"))
    return replace(t, **{name: fail(getattr(t, name)) for name in SENSOR_TABLES if name not in but})


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("facts"))
    t = sensor_tables(spark)
    scope = Scope.for_range(spark, FIRST, LAST, as_of=LATER)
    return t, scope, root, found(report_cells(t, scope, store=FactStore(spark, root)))


def test_cells_from_the_store_equal_those_without(spark, stored):
    t, scope, root, cells = stored
    assert cells == found(report_cells(t, scope))
    assert set(FactStore(spark, root).entries()) == {(f.name, d) for f in FACTS for d in all_dates(f)}


def test_stored_facts_are_read_without_the_tables(spark, stored):
    t, scope, root, cells = stored
    with pytest.raises(Exception, match="read"):
        report_cells(unreadable(t), scope)
    assert found(report_cells(unreadable(t), scope, store=FactStore(spark, root))) == cells
    # Any part of the dates, by itself.
    part = Scope.for_range(spark, D, D + timedelta(days=2), as_of=LATER)
    assert found(report_cells(unreadable(t), part, store=FactStore(spark, root))) == found(report_cells(t, part))


def test_dates_computed_one_by_one_give_the_same_facts(spark, stored, tmp_path):
    t, scope, _, cells = stored
    store = FactStore(spark, str(tmp_path / "facts"))
    for d in (date(2024, 3, 9), FIRST, D, date(2024, 3, 7)):
        store.facts(t, Scope.for_range(spark, d, d, as_of=LATER))
    assert found(report_cells(t, scope, store=store)) == cells
    assert len({n for n, _ in store.entries().values()}) == 5


@pytest.mark.parametrize("table, row", [
    ("md", (at(D, 12), 900, 1, 1)),
    ("counters", (at(D, 21, 30), 900, 150.0, 15.0, 21.0, 31.0, 41.0)),
    ("silos_b", (at(D, 6, 10), 900, 7, 2, 9.0)),
    ("machines", (at(D, 23, 0), 1, 900, 4, 120, "Carga")),
])
def test_a_late_row_computes_only_what_it_touches(spark, tmp_path, table, row):
    t, root = sensor_tables(spark), str(tmp_path / "facts")
    scope = Scope.for_range(spark, FIRST, LAST, as_of=LATER)
    store = FactStore(spark, root)
    before = found(report_cells(t, scope, store=store))
    old = store.entries()
    late = spark.createDataFrame([row], getattr(t, table).schema)
    after = replace(t, **{table: getattr(t, table).unionByName(late)})
    dates = affected_dates(late, table, after)
    touched = set(store.forget(table, dates))
    depends = {f.name for f in FACTS if table in f.tables}
    assert touched == {(f.name, d) for f in FACTS if f.name in depends for d in all_dates(f) if d in set(dates)}
    read = {x for f in FACTS if f.name in depends for x in f.tables}
    got = found(report_cells(unreadable(after, but=read), scope, store=store))
    assert got == found(report_cells(after, scope)) != before
    new = store.entries()
    assert {k for k in new if new[k] != old[k]} == touched
    store.drop_unused()
    assert found(report_cells(unreadable(after), scope, store=store)) == got


def test_facts_that_are_not_final_are_computed_again(spark, tmp_path):
    t, store = sensor_tables(spark), FactStore(spark, str(tmp_path / "facts"))
    early = Scope.for_range(spark, D, D, as_of=datetime(2024, 3, 6, 8, 30))
    store.facts(t, early)
    assert all(D in days for days in store.missing(early, store.entries()).values())
    late = Scope.for_range(spark, D, D, as_of=final_at(D + timedelta(days=1), DEFAULT_CONFIG.tz))
    assert found(report_cells(t, late, store=store)) == found(report_cells(t, late))
    assert not any(store.missing(late, store.entries()).values())
    # An earlier "now" gets the facts of that time.
    assert found(report_cells(t, early, store=store)) == found(report_cells(t, early))


def test_configurations_do_not_share_facts(spark, tmp_path):
    root = str(tmp_path / "facts")
    assert FactStore(spark, root).root == FactStore(spark, root, replace(DEFAULT_CONFIG, window_chunk=timedelta(minutes=5))).root
    assert FactStore(spark, root).root != FactStore(spark, root, replace(DEFAULT_CONFIG, gap_cap=timedelta(minutes=3))).root


def test_a_run_that_breaks_off_leaves_the_store(spark, tmp_path, monkeypatch):
    t, store = sensor_tables(spark), FactStore(spark, str(tmp_path / "facts"))
    scope = Scope.for_range(spark, D, D, as_of=LATER)
    real = facts.versions.finish
    for stop_at in (1, 2):           # when the ingest, or the manifest, would be marked ready
        calls = []

        def breaking(spark, root, n):
            calls.append(root)
            if len(calls) == stop_at:
                raise KeyboardInterrupt
            real(spark, root, n)
        monkeypatch.setattr(facts.versions, "finish", breaking)
        with pytest.raises(KeyboardInterrupt):
            store.facts(t, scope)
        monkeypatch.setattr(facts.versions, "finish", real)
        assert store.entries() == {}
    assert found(report_cells(t, scope, store=store)) == found(report_cells(t, scope))
    with pytest.raises(ValueError):
        store.forget("nosuch", [D])


def test_backfill_and_refresh_keep_facts(spark, tmp_path):
    out, root, src = str(tmp_path / "cells"), str(tmp_path / "facts"), str(tmp_path / "md")
    t = sensor_tables(spark)
    backfill(spark, t, FIRST, D, out, as_of=LATER, facts_dir=root)
    assert ("md_ext", D) in FactStore(spark, root).entries()
    late = spark.createDataFrame([(at(D, 12), 900, 1, 1), (at(D, 12, 1), 901, 0, 0)], t.md.schema)
    late.write.parquet(src)
    after = replace(t, md=t.md.unionByName(late))
    old = FactStore(spark, root).entries()
    q = refresh_on_arrival(spark, src, "ts timestamp_ntz, id long, running int, loaded int", lambda: after, out,
                           str(tmp_path / "ck"), as_of=LATER, facts_dir=root)
    q.awaitTermination(300)
    new = FactStore(spark, root).entries()
    assert {fact for fact, d in old if new[fact, d] != old[fact, d]} == {"md_ext"}
    got = read_report(spark, out).filter(F.col("report_date") == F.lit(D))
    assert found(got) == found(report_cells(after, Scope.for_range(spark, D, D, as_of=LATER)))
