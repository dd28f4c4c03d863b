"""Oracle SQL for the disinfection cycle counts (Q10, Q12, Q20, Q21).

A cycle is named by the row that starts it: the first of a machine's rows in
the window, or one whose operation differs from that of the machine's row
before it.  Every row belongs to the latest start.
"""

from oracle.sql import TZ, q


def ended(ids: tuple[int, ...], first: str, last: str) -> str:
    """``ended(report_date, machine_id, end_ts)``: local end of each cycle that is to be counted, by window."""
    return f"""
rows_in_order AS (
  SELECT machine_id, operation_id, theoretical_min, ts AT TIME ZONE {TZ} AS local_ts,
         row_number() OVER of_machine AS place, lag(ts AT TIME ZONE {TZ}) OVER of_machine AS ts_before,
         lag(operation_id) OVER of_machine AS operation_before
  FROM machines WHERE machine_id IN {ids} AND operation_id IS NOT NULL
  WINDOW of_machine AS (PARTITION BY machine_id ORDER BY ts, record_id)
),
named AS (
  SELECT d.report_date, r.machine_id, r.operation_id, r.theoretical_min, r.local_ts,
         max(CASE WHEN r.ts_before IS NULL OR r.ts_before < {first} OR r.operation_before <> r.operation_id THEN r.place END)
           OVER (PARTITION BY d.report_date, r.machine_id ORDER BY r.place) AS cycle
  FROM dates d JOIN rows_in_order r ON r.local_ts >= {first} AND r.local_ts < {last}
),
ended AS (
  SELECT report_date, machine_id, min(local_ts) + max(theoretical_min) * INTERVAL 1 MINUTE AS end_ts
  FROM named GROUP BY report_date, machine_id, cycle HAVING max(theoretical_min) > 45
)"""


def scaffold(ids: tuple[int, ...]) -> str:
    return "dates d, (VALUES " + ", ".join(f"({i})" for i in ids) + ") m(machine_id)"


def day_query(ids: tuple[int, ...]) -> str:
    return q(f"""
SELECT report_date, COALESCE(vapex, 'TOTAL') AS vapex, CAST(sum(t1) AS BIGINT) AS t1, CAST(sum(t2) AS BIGINT) AS t2,
       CAST(sum(t3) AS BIGINT) AS t3, CAST(sum(t1 + t2 + t3) AS BIGINT) AS total
FROM (
  SELECT d.report_date, 'VAPEX ' || m.machine_id AS vapex, count(*) FILTER (WHERE hour(e.end_ts) < 8) AS t1,
         count(*) FILTER (WHERE hour(e.end_ts) BETWEEN 8 AND 15) AS t2, count(*) FILTER (WHERE hour(e.end_ts) > 15) AS t3
  FROM {scaffold(ids)}
  LEFT JOIN ended e ON e.report_date = d.report_date AND e.machine_id = m.machine_id AND CAST(e.end_ts AS DATE) = d.report_date
  GROUP BY ALL
)
GROUP BY GROUPING SETS ((report_date, vapex), (report_date))""",
        ended(ids, "(d.report_date - INTERVAL 12 HOUR)", "(d.report_date + INTERVAL 36 HOUR)"))


def current_query(ids: tuple[int, ...]) -> str:
    return q(f"""
SELECT report_date, COALESCE(vapex, 'TOTAL') AS vapex, CAST(sum(n) AS BIGINT) AS atual_00_08
FROM (
  SELECT d.report_date, 'VAPEX ' || m.machine_id AS vapex, count(e.end_ts) AS n
  FROM {scaffold(ids)}
  LEFT JOIN ended e ON e.report_date = d.report_date AND e.machine_id = m.machine_id
   AND CAST(e.end_ts AS DATE) = d.report_date + 1 AND hour(e.end_ts) < 8
  GROUP BY ALL
)
GROUP BY GROUPING SETS ((report_date, vapex), (report_date))""",
        ended(ids, "(d.report_date + INTERVAL 12 HOUR)", "(d.report_date + INTERVAL 44 HOUR)"))


# All cycles of all machines by window of the day, counted or not.
CYCLE_ISLANDS = q("""
SELECT report_date, machine_id, count(*) AS n_cycles, count(*) FILTER (WHERE longest > 45) AS n_valid,
       CAST(sum(longest) AS BIGINT) AS sum_theoretical, CAST(sum(operation_id) AS BIGINT) AS sum_operation
FROM (SELECT report_date, machine_id, cycle, operation_id, max(theoretical_min) AS longest FROM named GROUP BY ALL)
GROUP BY report_date, machine_id""",
    ended(tuple(range(1, 10)), "(d.report_date - INTERVAL 12 HOUR)", "(d.report_date + INTERVAL 36 HOUR)"))

QUERIES = {
    "cycle_islands": CYCLE_ISLANDS,
    "disinfections_vinc": day_query((1, 2, 3, 4)),
    "disinfections_grinding": day_query((5, 6, 7, 8, 9)),
    "disinfections_vinc_current": current_query((1, 2, 3, 4)),
    "disinfections_grinding_current": current_query((5, 6, 7, 8, 9)),
}
