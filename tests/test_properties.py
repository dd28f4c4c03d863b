"""Properties: one pass over many dates equals the union of
single-date runs; segment time never exceeds the shift; totals add up."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from shiftmetrics.config import DEFAULT_CONFIG
from shiftmetrics.plans import activity, blocks, calibration, disinfection, grinding
from shiftmetrics.plans.scope import Scope
from shiftmetrics.sources.fixtures import fixture_tables

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 4, 14, 12, 0)
DATES = [date(2024, 3, 30), date(2024, 3, 31), date(2024, 4, 1)]
PLANS = [grinding.md_runtime, grinding.mill_hours_current, grinding.silo_kg_grinding,
         grinding.silo_snapshot_vinc, calibration.granulate_by_product, calibration.calibration_oee,
         disinfection.disinfections_vinc, disinfection.disinfections_grinding_current,
         activity.report_activity]


@pytest.fixture(scope="module")
def t(spark):
    return fixture_tables(spark, SF)


@pytest.mark.parametrize("plan", PLANS, ids=lambda p: p.__name__)
def test_range_equals_union_of_single_dates(spark, t, plan):
    whole = sorted(map(tuple, plan(t, Scope.for_range(spark, DATES[0], DATES[-1], AS_OF)).collect()))
    single = sorted(r for d in DATES for r in map(tuple, plan(t, Scope.for_range(spark, d, d, AS_OF)).collect()))
    assert whole == single


def test_segment_time_within_shift(spark, t):
    s = Scope.for_range(spark, date(2024, 3, 20), date(2024, 4, 5), AS_OF)
    seg = blocks.segment_durations(t, s)
    grid = blocks.shift_grid_day(t, s).select("report_date", "shift", "length_s")
    bad = seg.join(grid, ["report_date", "shift"]).filter("covered_us > length_s * 1000000")
    assert bad.count() == 0


def test_kg_totals_add_up_and_are_non_negative(spark, t):
    s = Scope.for_range(spark, date(2024, 3, 20), date(2024, 4, 5), AS_OF)
    for df in (grinding.silo_kg_grinding(t, s), grinding.silo_kg_disinfection(t, s)):
        for r in df.collect():
            assert r["t1_00_08"] + r["t2_08_16"] + r["t3_16_24"] == r["total"]
            assert min(r["t1_00_08"], r["t2_08_16"], r["t3_16_24"]) >= 0
    g = calibration.granulate_by_product(t, s)
    for r in g.collect():
        assert r["t1_22_06"] + r["t2_06_14"] + r["t3_14_22"] == r["total_kg"]


CHUNKED = [grinding.md_runtime, grinding.mill_hours, grinding.silo_kg_grinding, calibration.calibration_state_time,
           disinfection.disinfections_vinc, activity.report_activity]


@pytest.mark.parametrize("plan", CHUNKED, ids=lambda p: p.__name__)
def test_chunk_width_does_not_change_results(spark, t, plan):
    s = Scope.for_range(spark, DATES[0], DATES[-1], AS_OF)
    narrow = replace(DEFAULT_CONFIG, window_chunk=timedelta(minutes=1))
    assert sorted(map(tuple, plan(t, s, narrow).collect())) == sorted(map(tuple, plan(t, s).collect()))
