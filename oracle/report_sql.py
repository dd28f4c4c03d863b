"""Oracle SQL for activity, calendar, operator-level keys and the mart."""

from oracle.sql import TZ, q

ACTIVITY_CTES = f"""
counter_steps AS (
  SELECT ts AT TIME ZONE {TZ} AS local_ts, total - lag(total) OVER (ORDER BY ts, id) AS step
  FROM counters WHERE total IS NOT NULL
),
steps_of_day AS (
  -- A day runs from 06:00 to 06:00; a sample at 06:00 ends one day and begins the next.
  SELECT CAST(local_ts - INTERVAL 6 HOUR AS DATE) AS report_date, step FROM counter_steps
  UNION ALL
  SELECT CAST(local_ts AS DATE) - 1, step FROM counter_steps WHERE local_ts = CAST(local_ts AS DATE) + INTERVAL 6 HOUR
),
largest_step AS (SELECT report_date, max(step) AS step FROM steps_of_day GROUP BY report_date),
active AS (
  SELECT DISTINCT CAST((ts AT TIME ZONE {TZ}) - INTERVAL 8 HOUR AS DATE) AS report_date, 'md' AS source
  FROM md WHERE running = 1 OR loaded = 1
  UNION
  SELECT CAST((ts AT TIME ZONE {TZ}) - INTERVAL 8 HOUR AS DATE), 'machine'
  FROM machines WHERE state IN ('Funcionamento', 'Carga', 'Descarga')
),
activity AS (
  SELECT d.report_date,
         (d.report_date, 'md') IN (SELECT (report_date, source) FROM active) AS md_active,
         COALESCE(l.step >= 10, FALSE) AS counter_active,
         (d.report_date, 'machine') IN (SELECT (report_date, source) FROM active) AS vapex_active,
         CAST(l.step AS DOUBLE) AS max_counter_step
  FROM dates d LEFT JOIN largest_step l USING (report_date)
)"""

REPORT_ACTIVITY = q("""
SELECT report_date, md_active, counter_active, vapex_active, max_counter_step,
       (md_active OR counter_active OR vapex_active) AS has_production
FROM activity""", ACTIVITY_CTES)

QUERIES = {
    "report_activity": REPORT_ACTIVITY,
}


def grid_cells(shifts: str, table: str) -> str:
    return q(f"""
SELECT s.report_date, s.shift,
       strftime(s.start_ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS start_utc,
       strftime(s.end_ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS end_utc,
       (epoch_us(s.end_ts) - epoch_us(s.start_ts)) // 1000000 AS length_s,
       (SELECT count(*) FROM {table} x WHERE x.ts >= s.start_ts AND x.ts < s.end_ts) AS n_samples
FROM {shifts} s""")


WINDOW_CLAMP = q("""
SELECT report_date, shift, strftime(end_eff AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS end_eff_utc,
       epoch_us(end_eff) - epoch_us(start_ts) AS eff_us,
       (SELECT count(*) FROM md WHERE ts >= start_ts AND ts < end_eff) AS n_samples
FROM day_shifts_eff""")

CARRY_IN_LATEST = q("""
SELECT report_date, shift, silo_id, strftime(ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS carry_ts,
       id, state, kg
FROM (
  SELECT s.report_date, s.shift, x.silo_id, x.ts, x.id, x.state, x.kg,
         row_number() OVER (PARTITION BY s.report_date, s.shift, x.silo_id ORDER BY x.ts DESC, x.id DESC) AS rn
  FROM day_shifts s JOIN silos_a x ON x.ts < s.start_ts AND x.ts >= s.start_ts - INTERVAL 12 HOUR
) WHERE rn = 1""")

COUNTER_ASOF = q("""
SELECT report_date, shift, asof_id, CAST(total AS DOUBLE) AS total, CAST(p1_2 AS DOUBLE) AS p1_2 FROM (
  SELECT s.report_date, s.shift,
         (SELECT g.id FROM counters g WHERE g.ts <= s.start_ts ORDER BY g.ts DESC, g.id DESC LIMIT 1) AS asof_id,
         (SELECT g.total FROM counters g WHERE g.ts <= s.start_ts ORDER BY g.ts DESC, g.id DESC LIMIT 1) AS total,
         (SELECT g.p1_2 FROM counters g WHERE g.ts <= s.start_ts ORDER BY g.ts DESC, g.id DESC LIMIT 1) AS p1_2
  FROM cal_shifts s
) WHERE asof_id IS NOT NULL""")


def _segment_durations() -> str:
    from oracle.sql import credited
    return q(f"""
SELECT report_date, shift, sf_id, CAST(sum(us) AS BIGINT) AS covered_us, count(*) AS n_segments
FROM ({credited("day_shifts_eff", "screws", "sf_id", "freq", "sf_id BETWEEN 1 AND 5")})
WHERE us > 0 GROUP BY ALL""")


def _state_time() -> str:
    from oracle.calibration_sql import state_time
    return q("SELECT report_date, shift, prod_us, idle_us, off_us FROM time_by_shift", state_time("cal_shifts"))


CALENDAR_CTES = f"""
cal AS (
  -- Weekends and holidays together cannot reach further than this without a working day.
  SELECT CAST(unnest(generate_series((SELECT min(report_date) FROM dates) - reach, (SELECT max(report_date) FROM dates) + reach,
                                     INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT to_days(CAST(7 * (count(*) + 2) AS INTEGER)) AS reach FROM holidays)
),
cal_flags AS (
  SELECT day, isodow(day) <= 5 AS is_weekday, day IN (SELECT day FROM holidays) AS is_holiday FROM cal
),
cal_op AS (SELECT *, is_weekday AND NOT is_holiday AS is_operational FROM cal_flags),
calendar AS (
  SELECT d.report_date, c.is_weekday, c.is_holiday, c.is_operational,
         (SELECT max(x.day) FROM cal_op x WHERE x.is_operational AND x.day < d.report_date) AS previous_operational_day,
         (SELECT min(x.day) FROM cal_op x WHERE x.is_operational AND x.day > d.report_date) AS next_operational_day,
         (d.report_date + INTERVAL 1 DAY + INTERVAL 8 HOUR + INTERVAL 15 MINUTE) AT TIME ZONE {TZ} AS ready_at
  FROM dates d JOIN cal_op c ON c.day = d.report_date
)"""

OPERATIONAL_CALENDAR = q("""
SELECT report_date, is_weekday, is_holiday, is_operational, previous_operational_day, next_operational_day,
       CAST(GREATEST(60, floor(date_diff('day', report_date, next_operational_day) * 86400
              - (SELECT epoch_us(now_ts AT TIME ZONE 'Europe/Lisbon') % 86400000000 FROM nowv) / 1e6)) AS BIGINT) AS seconds_to_next_operational,
       strftime(ready_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ready_at_utc,
       strftime(report_date, '%d/%m/%Y') AS report_label,
       strftime(report_date + INTERVAL 1 DAY, '%d/%m/%Y') AS snapshot_label,
       'Atual 00-08 (' || strftime(report_date + INTERVAL 1 DAY, '%d/%m') || ')' AS current_label,
       (SELECT count(*) FROM md WHERE CAST(ts AT TIME ZONE 'Europe/Lisbon' AS DATE) = report_date) AS n_samples
FROM calendar""", CALENDAR_CTES)

REPORT_DAYS = q("""
SELECT c.report_date, c.is_operational, a.md_active OR a.counter_active OR a.vapex_active AS has_production,
       c.is_operational OR a.md_active OR a.counter_active OR a.vapex_active AS send,
       (SELECT now_ts FROM nowv) >= c.ready_at AS is_ready
FROM calendar c JOIN activity a ON a.report_date = c.report_date""", CALENDAR_CTES + "," + ACTIVITY_CTES)

QUERIES.update({
    "shift_grid_day": grid_cells("day_shifts", "md"),
    "shift_grid_calibration": grid_cells("cal_shifts", "remill"),
    "window_clamp": WINDOW_CLAMP,
    "carry_in_latest": CARRY_IN_LATEST,
    "counter_asof": COUNTER_ASOF,
    "segment_durations": _segment_durations(),
    "calibration_state_time": _state_time(),
    "operational_calendar": OPERATIONAL_CALENDAR,
    "report_days": REPORT_DAYS,
})


def _state_sweep() -> str:
    from oracle.calibration_sql import state_time
    return q("""
SELECT report_date, shift, strftime(ts AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f') AS ts_utc, flag, any_state, us AS dur_us
FROM held""", state_time("cal_shifts"))


QUERIES["state_sweep"] = _state_sweep()
