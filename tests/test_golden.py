"""Golden micro-cases: hand-computed expectations for the semantic traps."""

from datetime import date, datetime, timedelta

from golden import at, one, scope, tables
from shiftmetrics.plans import activity, blocks, calibration, disinfection, grinding, opcalendar

D = date(2024, 3, 5)          # winter: local time = UTC
PREV = D - timedelta(days=1)


def mill_secs(spark, rows, **kw):
    t = tables(spark, screws=rows)
    f = grinding.mill_shift_facts(t, scope(spark, D, **kw))
    return {r["shift"]: r["work_us"] / 1e6 for r in f.collect()}


def test_gap_cap_and_last_sample(spark):
    # 08:00 -> 08:01:30 (90 s), -> 08:03:30 (120 s), -> 08:13:30 (cap 120 s),
    # last sample 30 s before the shift end (30 s).
    rows = [(at(D, 8), 1, 2.0), (at(D, 8, 1, 30), 1, 2.0), (at(D, 8, 3, 30), 1, 2.0),
            (at(D, 8, 13, 30), 1, 0.0), (at(D, 15, 59, 30), 1, 2.0)]
    assert mill_secs(spark, rows)[2] == 90 + 120 + 120 + 30


def test_carry_in_lookback_edges(spark):
    # Shift 2 starts 08:00; carry-ins 12 h, 11 h 59 m and 12 h 01 m before it.
    t_exact = at(D, 8) - timedelta(hours=12)
    t_in = at(D, 8) - timedelta(hours=11, minutes=59)
    t_out = at(D, 8) - timedelta(hours=12, minutes=1)
    for ts, expect in ((t_exact, True), (t_in, True), (t_out, False)):
        t = tables(spark, silos_a=[(ts, 1, 1, 100.0), (at(D, 9), 1, 1, 150.0)])
        rows = blocks.carry_in_latest(t, scope(spark, D)).filter("shift = 2").collect()
        assert (len(rows) == 1) == expect, (ts, rows)


def test_carry_in_credit_and_start_sample(spark):
    # Carry-in 60 s before the start, next sample 5 min later: 60 s credited.
    rows = [(at(D, 7, 59), 1, 2.0), (at(D, 8, 5), 1, 0.0)]
    assert mill_secs(spark, rows)[2] == 60
    # 3 min before: the 2-minute cap ends it before the start.
    rows = [(at(D, 7, 57), 1, 2.0), (at(D, 8, 5), 1, 0.0)]
    assert mill_secs(spark, rows).get(2, 0) == 0
    # A sample exactly at the start belongs to the shift; the carry-in still exists.
    rows = [(at(D, 7, 59), 1, 2.0), (at(D, 8), 1, 2.0), (at(D, 8, 1), 1, 0.0)]
    assert mill_secs(spark, rows)[2] == 60


def test_freq_threshold_and_max_over_screws(spark):
    rows = [(at(D, 8), 1, 1.0), (at(D, 8, 1), 1, 0.0),      # freq 1: not running
            (at(D, 8), 2, 1.1), (at(D, 8, 1), 2, 0.0),      # 60 s
            (at(D, 9), 3, 3.0), (at(D, 9, 1, 30), 3, 0.0)]  # 90 s -> max
    assert mill_secs(spark, rows)[2] == 90
    rows += [(at(D, 17), 1, 3.0), (at(D, 17, 2), 1, 0.0)]   # shift 3: 120 s
    t = tables(spark, screws=rows)
    r = one(grinding.mill_hours(t, scope(spark, D)))
    assert (r["t2_08_16"], r["t3_16_24"], r["total"]) == ("00h01", "00h02", "00h03")


def test_clamp_to_as_of(spark):
    rows = [(at(D, 8), 1, 2.0), (at(D, 8, 1), 1, 2.0), (at(D, 8, 2), 1, 2.0)]
    assert mill_secs(spark, rows, as_of=at(D, 8, 1, 30))[2] == 90   # inside the shift
    assert mill_secs(spark, rows, as_of=at(D, 7)).get(2, 0) == 0     # before the shift
    assert mill_secs(spark, rows, as_of=at(D, 20))[2] == 240          # after: no clamp


def test_md_runtime_text_and_rounding(spark):
    # 150 s running (2.5 min -> 3), loaded 120 s of it (80 %).
    rows = [(at(D, 8), 1, 1), (at(D, 8, 2), 1, 0), (at(D, 8, 2, 30), 0, 0)]
    t = tables(spark, md=rows)
    r = one(grinding.md_runtime(t, scope(spark, D)))
    assert r["t2_08_16"] == "00h03 (80%)"
    assert r["t1_00_08"] == "00h00 (0%)"
    assert r["total"] == "00h03 (80%)"


def test_full_day_prints_24h00(spark):
    rows = [(at(D, 0) + timedelta(minutes=2 * i), 1, 0) for i in range(720)]
    t = tables(spark, md=rows)
    r = one(grinding.md_runtime(t, scope(spark, D)))
    assert r["total"] == "24h00 (0%)"


def test_gated_level_gain(spark):
    rows = [(at(D, 8), 1, 1, 100.0),       # first row: no step
            (at(D, 8, 5), 1, 1, 130.0),    # +30 filling: counts
            (at(D, 8, 10), 1, 2, 150.0),   # +20 emptying: no
            (at(D, 8, 15), 1, 1, 140.0),   # falling: no
            (at(D, 8, 20), 1, 1, None),    # NULL level: no step either side
            (at(D, 8, 25), 1, 1, 200.0)]
    t = tables(spark, silos_a=rows)
    r = one(grinding.silo_kg_grinding(t, scope(spark, D)))
    assert (r["t2_08_16"], r["total"]) == (30.0, 30.0)


def test_counter_asof_boundaries_resets_and_nulls(spark):
    # Calibration shift 2 of D is 06:00-14:00.
    c = [(at(D, 6), 10.0, 100.0, 50.0, 0.0, 7.0),           # exactly at the boundary: belongs to it
         (at(D, 14), 40.0, 160.0, 20.0, 0.0, None)]         # reset on p1_2, NULL p3_7 at the latest row
    t = tables(spark, counters=[(ts, tot, a, b, c_, d) for ts, tot, a, b, c_, d in c])
    g = calibration.granulate_by_product(t, scope(spark, D))
    r = one(g, produto="05A1")
    assert (r["t1_22_06"], r["t2_06_14"], r["t3_14_22"]) == (100, 60, 0)   # no earlier sample: full value
    assert one(g, produto="1A2")["t2_06_14"] == 0                            # reset clamps to 0
    assert one(g, produto="2A3")["total_kg"] == 0
    assert one(g, produto="3A7")["t2_06_14"] == 0                            # NULL latest -> 0 - 7 -> 0
    tot = one(g, produto="Total")
    assert tot["percentagem"] is None and tot["total_kg"] == 100 + 60 + 50 + 7
    assert one(g, produto="05A1")["percentagem"] == round(100 * 160 / 217)


def test_share_zero_total(spark):
    t = tables(spark)
    g = calibration.granulate_by_product(t, scope(spark, D))
    assert {r["percentagem"] for r in g.collect() if r["produto"] != "Total"} == {0.0}


def test_sweep_segment_edges(spark):
    # Calibration shift 2 (06:00-14:00).  Silo 6 empties from 07:00 to 08:00.
    silos = [(at(D, 7), 6, 2, 0.0), (at(D, 8), 6, 1, 0.0)]
    remill = [(at(D, 6, 30), 1, 0),      # before: not emptying -> idle
              (at(D, 7), 1, 0),          # start inclusive -> productive
              (at(D, 8), 1, 0),          # end exclusive -> idle until 09:00
              (at(D, 9), 0, 0)]          # section off to the shift end, no cap
    t = tables(spark, silos_b=silos, remill=remill)
    f = calibration.calibration_state_time(t, scope(spark, D))
    r = one(f, shift=2)
    assert r["prod_us"] == 3600 * 10**6
    assert r["idle_us"] == (1800 + 3600) * 10**6
    assert r["off_us"] == 5 * 3600 * 10**6


def test_oee_uncapped_factors_and_day_from_sums(spark):
    # Shift 2: 1 h productive, 1625 kg -> performance 130 %; no idle -> availability 100 %.
    remill = [(at(D, 7), 1, 0), (at(D, 8), 0, 0)]
    silos = [(at(D, 6), 6, 2, 0.0)]
    counters = [(at(D, 6), 0.0, 0.0, 0.0, 0.0, 0.0), (at(D, 14), 1625.0, 0.0, 0.0, 0.0, 0.0)]
    t = tables(spark, remill=remill, silos_b=silos, counters=counters)
    o = calibration.calibration_oee(t, scope(spark, D))
    assert one(o, indicador="Performance")["t2_06_14"] == 100.0
    assert one(o, indicador="OEE")["t2_06_14"] == 100.0         # 130 x 100 / 100 capped
    assert one(o, indicador="Disponibilidade")["dia"] == 100.0


def test_cycles_null_rows_threshold_and_next_day(spark):
    m = [(at(D, 10), 5, 1, 1, 46, "Carga"),
         (at(D, 10, 5), 5, 2, None, 30, "Parado"),    # NULL operation: dropped before LAG
         (at(D, 10, 10), 5, 3, 1, 30, "Carga"),       # same cycle
         (at(D, 11), 5, 4, 2, 45, "Carga"),           # 45: not counted
         (at(D, 23, 30), 5, 5, 3, 60, "Carga")]       # scheduled 00:30 next day
    t = tables(spark, machines=m)
    d = disinfection.disinfections_grinding(t, scope(spark, D, D + timedelta(days=1)))
    r = one(d, report_date=D, vapex="VAPEX 5")
    assert (r["t1"], r["t2"], r["t3"], r["total"]) == (0, 1, 0, 1)
    r2 = one(d, report_date=D + timedelta(days=1), vapex="VAPEX 5")
    assert r2["t1"] == 1
    c = disinfection.disinfections_grinding_current(t, scope(spark, D))
    assert one(c, vapex="VAPEX 5")["atual_00_08"] == 1


def test_snapshot_edges(spark):
    nxt = D + timedelta(days=1)
    a = [(at(nxt, 8), 1, 0, 10.0), (at(nxt, 8, 0, 1), 1, 0, 99.0)]
    c = [(at(nxt, 8, 4), 1, 5.0), (at(nxt, 8, 5, 1), 1, 7.0), (at(nxt, 7), 7, 3.0)]
    t = tables(spark, silos_a=a, silos_c=c)
    assert one(grinding.silo_total_8h_grinding(t, scope(spark, D)))["total"] == 10.0
    r = one(grinding.silo_snapshot_vinc(t, scope(spark, D)))
    assert r["silo_1_3a7_cs"] == 5.0 and r["silo_2_2a3_cs"] == 0


def test_activity_step_at_0600_counts_for_both_days(spark):
    nxt = D + timedelta(days=1)
    c = [(at(nxt, 5), 0.0, 0.0, 0.0, 0.0, 0.0), (at(nxt, 6), 10.0, 0.0, 0.0, 0.0, 0.0)]
    t = tables(spark, counters=c)
    a = activity.report_activity(t, scope(spark, D, nxt))
    got = {r["report_date"]: r["counter_active"] for r in a.collect()}
    assert got == {D: True, nxt: True}


def test_dst_shift_lengths(spark):
    dst = date(2024, 3, 31)
    g = {r["shift"]: r["length_s"] for r in blocks.shift_grid_day(tables(spark), scope(spark, dst)).collect()}
    assert g == {1: 7 * 3600, 2: 8 * 3600, 3: 8 * 3600}
    c = {r["shift"]: r["length_s"] for r in blocks.shift_grid_calibration(tables(spark), scope(spark, dst)).collect()}
    assert c == {1: 7 * 3600, 2: 8 * 3600, 3: 8 * 3600}


def test_formats(spark):
    from shiftmetrics.functions.formatting import hhmmss, kg_text, pct_text
    df = spark.createDataFrame([(45296.0, 10425.0, 73.6), (None, None, None), (0.0, 2.5, 5.0)],
                               "s double, kg double, p double")
    out = df.select(hhmmss("s").alias("a"), kg_text("kg").alias("b"),
                    pct_text("p").alias("c")).collect()
    assert [tuple(r) for r in out] == [("12:34:56", "10 425 kg", "73.6 %"),
                                       ("00:00:00", "0 kg", "0 %"),
                                       ("00:00:00", "2 kg", "5.0 %")]


def test_calendar(spark):
    from shiftmetrics.plans.opcalendar import holidays_frame, operational_calendar
    hol = holidays_frame(spark, " 2024-03-29, ,2024-04-01")
    cal = operational_calendar(scope(spark, date(2024, 3, 28), date(2024, 4, 2)), hol)
    got = {r["report_date"]: (r["is_operational"], r["previous_operational_day"]) for r in cal.collect()}
    assert got[date(2024, 3, 29)] == (False, date(2024, 3, 28))
    assert got[date(2024, 4, 2)] == (True, date(2024, 3, 28))
    assert got[date(2024, 3, 30)][0] is False


def test_as_of_is_zone_proof(spark):
    s = scope(spark, D, as_of=datetime(2024, 3, 5, 8, 30))
    assert spark.range(1).select(s.as_of.alias("x")).first()["x"] == datetime(2024, 3, 5, 8, 30)


def test_results_do_not_depend_on_session_zone(spark):
    rows = [(at(date(2024, 3, 31), 0, 30), 1, 1), (at(date(2024, 3, 31), 0, 31), 1, 0),
            (at(date(2024, 3, 31), 1, 30), 1, 1), (at(date(2024, 3, 31), 7, 59), 1, 1)]
    t = tables(spark, md=rows)
    s = scope(spark, date(2024, 3, 30), date(2024, 4, 1))
    utc = sorted(map(tuple, grinding.md_runtime(t, s).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(map(tuple, grinding.md_runtime(t, s).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_segments_across_chunk_edges(spark):
    # Windows are split by hour: successors just after 09:00 must still be seen.
    rows = [(at(D, 8, 59, 30), 1, 2.0), (at(D, 9, 0, 45), 1, 0.0),     # 75 s across the edge
            (at(D, 9, 59), 1, 2.0), (at(D, 10, 2, 30), 1, 0.0),         # next beyond the cap: 120 s
            (at(D, 10, 59, 59), 1, 2.0), (at(D, 11, 0, 0), 1, 2.0),     # 1 s, then 120 s
            (at(D, 11, 30), 1, 0.0)]
    assert mill_secs(spark, rows)[2] == 75 + 120 + 1 + 120


def test_level_gain_across_chunk_edges(spark):
    rows = [(at(D, 8, 59), 1, 1, 100.0), (at(D, 10, 30), 1, 1, 160.0),  # empty 09:00 chunk between
            (at(D, 11, 0), 1, 1, 150.0), (at(D, 12, 0), 1, 1, None), (at(D, 13, 0), 1, 1, 170.0)]
    t = tables(spark, silos_a=rows)
    assert one(grinding.silo_kg_grinding(t, scope(spark, D)))["t2_08_16"] == 60.0


def test_repeated_status_samples(spark):
    # Two identical status rows at 07:00 (deduplicated by the reference) and
    # two rows at 08:00 with different flags.
    remill = [(at(D, 7), 1, 0), (at(D, 7), 1, 0), (at(D, 8), 0, 0), (at(D, 8), 1, 0), (at(D, 9), 0, 0)]
    silos = [(at(D, 6), 6, 2, 0.0)]
    t = tables(spark, silos_b=silos, remill=remill)
    r = one(calibration.calibration_state_time(t, scope(spark, D)), shift=2)
    # 07:00-08:00 productive; at 08:00 the flag-0 row sorts first and gets 0 s,
    # the flag-1 row runs to 09:00; then off to 14:00.
    assert (r["prod_us"], r["idle_us"], r["off_us"]) == (2 * 3600 * 10**6, 0, 5 * 3600 * 10**6)
    rows = blocks.state_sweep(t, scope(spark, D)).filter("shift = 2").collect()
    assert len(rows) == 4          # 07:00 deduplicated; 08:00 x2 (two flags); 09:00


def test_cycle_restarts_at_window_edge(spark):
    # Operation 1 at D-1 11:50 and 12:10, theoretical 725 min (12 h 05).  The
    # window of D starts at D-1 12:00, so there the cycle starts at 12:10 and
    # is scheduled to end at D 00:15 (T1 of D); in the window of D-1 it starts
    # at 11:50 and ends at D-1 23:55 (T3 of D-1).  Both dates count it, as
    # the reference's per-date windows do.
    m = [(at(PREV, 11, 50), 5, 1, 1, 725, "Carga"), (at(PREV, 12, 10), 5, 2, 1, 725, "Carga")]
    t = tables(spark, machines=m)
    d = disinfection.disinfections_grinding(t, scope(spark, PREV, D))
    assert (one(d, report_date=D, vapex="VAPEX 5")["t1"], one(d, report_date=PREV, vapex="VAPEX 5")["t3"]) == (1, 1)


def test_null_entity_keeps_its_steps_across_chunks(spark):
    # Two samples of a silo without id, on both sides of the 09:00 chunk edge.
    t = tables(spark, silos_a=[(at(D, 8, 50), None, 1, 100.0), (at(D, 9, 10), None, 1, 160.0)])
    assert one(grinding.silo_kg_grinding(t, scope(spark, D)))["t2_08_16"] == 60.0


def test_long_shutdown_has_its_true_neighbours(spark):
    first = date(2024, 8, 1)
    t = tables(spark, holidays=[(first + timedelta(days=i),) for i in range(45)])
    s = scope(spark, date(2024, 8, 2), as_of=datetime(2024, 8, 2, 9, 30))     # 10:30 in Lisbon
    r = one(opcalendar.operational_calendar(s, t.holidays))
    assert r["previous_operational_day"] == date(2024, 7, 31)
    assert r["next_operational_day"] == date(2024, 9, 16)                     # the 15th is a Sunday
    assert r["seconds_to_next_operational"] == 45 * 86400 - (10 * 3600 + 1800)


def test_grinding_oee_rounds_exact_ties_up(spark):
    # 3,600 s of work and 1,030.225 kg are exactly 71.05 % of 1,450 kg/h.
    mill = [(at(D, 8) + timedelta(minutes=i), 1, 2.0) for i in range(60)] + [(at(D, 9), 1, 0.0)]
    silo = [(at(D, 8), 1, 1, 0.0), (at(D, 9), 1, 1, 1030.225)]
    r = one(grinding.grinding_oee(tables(spark, screws=mill, silos_a=silo), scope(spark, D)))
    assert (r["t2_08_16"], r["total"]) == (71.1, 71.1)


def test_calibration_oee_rounds_exact_ties_up(spark):
    # An hour of production and 888.125 kg are exactly 71.05 % of 1,250 kg/h; idle time is 0.
    t = tables(spark, remill=[(at(D, 8), 1, 0), (at(D, 9), 0, 0)], silos_b=[(at(D, 7), 6, 2, 1.0)],
               counters=[(at(D, 5), 1000.0, 0.0, 0.0, 0.0, 0.0), (at(D, 10), 1888.125, 0.0, 0.0, 0.0, 0.0)])
    rows = {r["indicador"]: r for r in calibration.calibration_oee(t, scope(spark, D)).collect()}
    assert rows["Performance"]["t2_06_14"] == 71.1 and rows["Disponibilidade"]["t2_06_14"] == 100.0
    assert rows["OEE"]["t2_06_14"] == 71.1
