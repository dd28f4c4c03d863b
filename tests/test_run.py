"""Daily run, backfill sink and the streaming refresh."""

import tempfile
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from golden import at, tables
from shiftmetrics.config import DEFAULT_CONFIG
from shiftmetrics.plans import grinding, run
from shiftmetrics.plans import report
from shiftmetrics.plans.report import read_report, report_cells
from shiftmetrics.plans.run import backfill, daily_run, report_date_for
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.prior import absorb_late, cutoff_for, prior_for_run, stored_cutoff, with_prior
from shiftmetrics.streaming import refresh_on_arrival
from shiftmetrics.streaming.refresh import affected_dates

D = date(2024, 3, 5)   # a Tuesday


def _md_rows():
    return [(at(D, 8), 1, 1), (at(D, 8, 1), 1, 0), (at(D, 9), 0, 0)]


def test_report_date_for():
    assert report_date_for(datetime(2024, 3, 6, 0, 30)) == D
    assert report_date_for(datetime(2024, 3, 31, 23, 30)) == date(2024, 3, 31)   # 00:30 local on 1 April


def test_daily_run_writes_ready_operational_day(spark):
    out = tempfile.mkdtemp(prefix="cells-")
    t = tables(spark, md=_md_rows())
    daily_run(spark, t, out, as_of=datetime(2024, 3, 6, 9, 0))
    written = read_report(spark, out)
    assert {r["report_date"] for r in written.select("report_date").distinct().collect()} == {D}
    assert written.filter("block = 'tempo_producao_md' AND `column` = 'T2(08-16)'").first()["display"] == "00h03 (33%)"   # 60 s loaded + 120 s capped
    # Not ready before 08:15 of the next day: nothing is written.
    out2 = tempfile.mkdtemp(prefix="cells-")
    assert daily_run(spark, t, out2, as_of=datetime(2024, 3, 6, 7, 0)).count() == 0


def test_backfill_skips_idle_weekend(spark):
    out = tempfile.mkdtemp(prefix="cells-")
    t = tables(spark, md=_md_rows())
    backfill(spark, t, date(2024, 3, 2), D, out, as_of=datetime(2024, 3, 7))
    got = {r["report_date"] for r in read_report(spark, out).select("report_date").distinct().collect()}
    assert got == {date(2024, 3, 4), D}          # Saturday 2nd and Sunday 3rd had no activity


def test_streaming_refresh(spark):
    src = tempfile.mkdtemp(prefix="md-src-")
    out = tempfile.mkdtemp(prefix="cells-")
    ck = tempfile.mkdtemp(prefix="ck-")
    t = tables(spark, md=_md_rows())
    t.md.write.mode("append").parquet(src)
    q = refresh_on_arrival(spark, src, "ts timestamp_ntz, id long, running int, loaded int",
                           lambda: t, out, ck)
    q.awaitTermination(300)
    got = {r["report_date"] for r in read_report(spark, out).select("report_date").distinct().collect()}
    assert D in got


def _late(spark, t, table, rows):
    """The tables with late rows in one of them."""
    return replace(t, **{table: getattr(t, table).unionByName(rows)})


@pytest.mark.parametrize("table, row", [
    ("counters", (at(D, 21, 30), 900, 900.0, 100.0, 0.0, 0.0, 0.0)),
    ("silos_c", (at(D, 21, 30), 900, 2, 77.0)),
    ("md", (at(D, 23, 59), 900, 1, 1)),
    ("machines", (at(D, 23, 0), 1, 900, 3, 120, "Carga")),
])
def test_affected_dates_cover_what_a_late_row_changes(spark, table, row):
    """Every date whose report differs after a late row is among the affected ones."""
    first, last = date(2024, 3, 4), date(2024, 3, 12)
    t = tables(spark, md=_md_rows(), counters=[(at(D, 10), 500.0, 20.0, 0.0, 0.0, 0.0), (at(date(2024, 3, 11), 9), 2000.0, 200.0, 0.0, 0.0, 0.0)],
               silos_c=[(at(date(2024, 3, 4)), 2, 5.0), (at(date(2024, 3, 10), 9), 2, 6.0)])
    rows = spark.createDataFrame([row], getattr(t, table).schema)
    after = _late(spark, t, table, rows)
    scope_ = Scope.for_range(spark, first, last, as_of=datetime(2099, 1, 1))

    def cells(x):
        found = {}
        for r in report_cells(x, scope_).collect():
            found.setdefault(r["report_date"], set()).add(tuple(r))
        return found
    old, new = cells(t), cells(after)
    changed = {d for d in old if old[d] != new[d]}
    assert changed and changed <= set(affected_dates(rows, table, after))


def test_prior_takes_up_late_rows(spark, tmp_path):
    state = str(tmp_path / "state")
    t = tables(spark, silos_a=[(at(date(2024, 3, 1)), 1, 1, 10.0)])
    cut = cutoff_for(D)
    prior_for_run(spark, t, state, cut)
    late = spark.createDataFrame([(at(date(2024, 3, 2)), 900, 1, 1, 70.0)], t.silos_a.schema)
    absorb_late(spark, state, "silos_a", late)
    after = _late(spark, t, "silos_a", late)
    s = Scope.for_range(spark, D, D, as_of=datetime(2099, 1, 1))
    want = grinding.silo_total_8h_grinding(after, s).first()["total"]
    got = grinding.silo_total_8h_grinding(with_prior(after, prior_for_run(spark, after, state, cut), cut), s).first()["total"]
    assert got == want == 70.0
    # A backfill of older dates leaves the index alone.
    prior_for_run(spark, after, state, cutoff_for(date(2024, 3, 2)))
    assert stored_cutoff(spark, state) == cut


def test_a_run_that_breaks_off_leaves_the_published_report(spark, tmp_path, monkeypatch):
    out, t = str(tmp_path / "cells"), tables(spark, md=_md_rows())

    def cells():
        return sorted(map(str, read_report(spark, out).collect()))

    backfill(spark, t, D, D, out, as_of=datetime(2024, 3, 8))
    before = cells()
    assert before and not [x for x in before if "00h05" in x]
    changed = tables(spark, md=[(at(D, 8), 1, 1), (at(D, 8, 2), 1, 1), (at(D, 8, 4), 1, 0), (at(D, 8, 5), 0, 0)])
    real = report.versions.finish
    for stop_at in (1, 2):              # when the run's folder, or the manifest, would be marked ready
        calls = []

        def breaking(spark, root, n):
            calls.append(root)
            if len(calls) == stop_at:
                raise KeyboardInterrupt
            real(spark, root, n)
        monkeypatch.setattr(report.versions, "finish", breaking)
        with pytest.raises(KeyboardInterrupt):
            backfill(spark, changed, D, D, out, as_of=datetime(2024, 3, 8))
        monkeypatch.setattr(report.versions, "finish", real)
        assert cells() == before
    backfill(spark, changed, D, D, out, as_of=datetime(2024, 3, 8))
    after = cells()
    assert [x for x in after if "00h05" in x]
    # Not ready is not the same as not to be sent.
    backfill(spark, t, D, D, out, as_of=datetime(2024, 3, 6, 7, 0))
    assert cells() == after
    report.drop_unpublished(spark, out)
    assert cells() == after


def test_rerun_removes_reports_that_are_no_longer_sent(spark, tmp_path):
    saturday = date(2024, 3, 2)
    out = str(tmp_path / "cells")
    busy = tables(spark, md=[(at(saturday, 9), 1, 1), (at(saturday, 9, 1), 0, 0)])
    backfill(spark, busy, saturday, saturday, out, as_of=datetime(2024, 3, 7))
    assert read_report(spark, out).count() > 0
    backfill(spark, tables(spark), saturday, date(2024, 3, 4), out, as_of=datetime(2024, 3, 7))
    assert {r["report_date"] for r in read_report(spark, out).select("report_date").distinct().collect()} == {date(2024, 3, 4)}


def test_a_failing_day_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "cells")
    bad = date(2024, 3, 5)
    real = run.report_cells

    def failing(t, s, cfg=DEFAULT_CONFIG, **more):
        cells = real(t, s, cfg, **more)
        return cells.filter((F.col("report_date") != bad) | (F.col("block") == "tempo_producao_md"))
    monkeypatch.setattr(run, "report_cells", failing)
    with pytest.raises(run.ReportErrors) as e:
        backfill(spark, tables(spark, md=_md_rows()), date(2024, 3, 4), date(2024, 3, 6), out, as_of=datetime(2024, 3, 8))
    assert set(e.value.errors) == {bad}
    written = {r["report_date"] for r in read_report(spark, out).select("report_date").distinct().collect()}
    assert written == {date(2024, 3, 4), date(2024, 3, 6)}
