"""Runs over prior ∪ recent rows equal runs over the whole history."""

from datetime import date, timedelta

import pytest

from shiftmetrics.plans import activity, calibration, grinding
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.fixtures import fixture_tables
from shiftmetrics.sources.prior import advance_prior, build_prior, cutoff_for, with_prior

SF = "/root/testdata/sf0.001"
FIRST, LAST = date(2024, 3, 28), date(2024, 4, 3)
PLANS = [grinding.silo_total_8h_disinfection, grinding.silo_snapshot_vinc, grinding.silo_kg_grinding,
         calibration.granulate_by_product, calibration.calibration_oee, activity.report_activity]


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.__name__)
def test_prior_is_exact(spark, plan):
    t = fixture_tables(spark, SF)
    scope = Scope.for_range(spark, FIRST, LAST, as_of=None)
    cut = cutoff_for(FIRST)
    # Build at an earlier cutoff, then advance: exercises incremental upkeep too.
    p0 = build_prior(t, cut - timedelta(days=3))
    prior = advance_prior(p0, t, cut - timedelta(days=3), cut)
    full = sorted(map(tuple, plan(t, scope).collect()))
    part = sorted(map(tuple, plan(with_prior(t, prior, cut), scope).collect()))
    assert full == part


def test_prior_upkeep_and_daily_run_with_state(spark, tmp_path):
    from datetime import datetime

    from shiftmetrics.plans.run import daily_run
    from shiftmetrics.sources.prior import prior_for_run
    t = fixture_tables(spark, SF)
    state = str(tmp_path / "state")
    c1, c2 = cutoff_for(date(2024, 4, 1)), cutoff_for(date(2024, 4, 3))
    prior_for_run(spark, t, state, c1)                      # built from the whole history
    advanced = prior_for_run(spark, t, state, c2)           # advanced over [c1, c2)
    again = prior_for_run(spark, t, state, c2)              # reused as stored
    fresh = build_prior(t, c2)
    for name in fresh:
        want = sorted(map(tuple, fresh[name].collect()))
        assert sorted(map(tuple, advanced[name].collect())) == want
        assert sorted(map(tuple, again[name].collect())) == want
    older = prior_for_run(spark, t, state, c1)              # a prefix of the index
    assert {n: sorted(map(tuple, df.collect())) for n, df in older.items()} == {
        n: sorted(map(tuple, df.collect())) for n, df in build_prior(t, c1).items()}
    as_of = datetime(2024, 4, 4, 9, 0)                      # report date 3 April
    a = sorted(map(tuple, daily_run(spark, t, str(tmp_path / "a"), as_of=as_of, state_dir=state).collect()))
    b = sorted(map(tuple, daily_run(spark, t, str(tmp_path / "b"), as_of=as_of).collect()))
    assert a and a == b


def test_index_by_day(spark, tmp_path, monkeypatch):
    """Old cutoffs and late rows read no history, broken-off ingests do not count, merging changes nothing."""
    from dataclasses import replace
    from datetime import datetime

    from golden import at, tables
    from shiftmetrics.sources import prior
    state = str(tmp_path / "state")
    days = [date(2024, 3, 1) + timedelta(days=k) for k in range(20)]
    t = tables(spark, silos_a=[(at(d, 10 + s), s, 1, float(k * 10 + s)) for k, d in enumerate(days) for s in (1, 2)],
               counters=[(at(d, 9), None if k % 3 else k * 5.0, 1.0, 1.0, 1.0, 1.0) for k, d in enumerate(days)])
    cuts = [cutoff_for(d) for d in (days[4], days[9], days[15])]

    def equal(tables_now, cut, reads):
        got = prior.prior_for_run(spark, reads, state, cut)
        want = build_prior(tables_now, cut)
        for name in ("silos_a", "counters"):
            assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].collect())), (name, cut)

    for cut in cuts:
        equal(t, cut, t)
    nothing = tables(spark)
    for cut in (*cuts, cutoff_for(days[7])):
        equal(t, cut, nothing)                     # the tables are not read
    late = spark.createDataFrame([(at(days[6], 23), 900, 1, 1, 777.0), (at(days[6], 1), 901, 2, 1, 1.0)], t.silos_a.schema)
    prior.absorb_late(spark, state, "silos_a", late)
    t = replace(t, silos_a=t.silos_a.unionByName(late))
    for cut in (cutoff_for(days[8]), cutoff_for(days[9]), cuts[2]):
        equal(t, cut, nothing)

    real = prior.versions.finish

    def breaking(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(prior.versions, "finish", breaking)
    with pytest.raises(KeyboardInterrupt):
        prior.prior_for_run(spark, t, state, cutoff_for(days[18]))
    monkeypatch.setattr(prior.versions, "finish", real)
    assert prior.stored_cutoff(spark, state) == cuts[2]
    equal(t, cutoff_for(days[18]), t)
    prior.compact(spark, state)
    assert len(prior.versions.ready(spark, state)) == 1
    for cut in (cuts[0], cutoff_for(days[8]), cutoff_for(days[18])):
        equal(t, cut, nothing)
    with pytest.raises(ValueError):
        prior.prior_for_run(spark, t, state, datetime(2024, 3, 5, 1))
