"""Oracle SQL for the calibration section (Q09, Q11, Q18, Q19).

Counters and silo states are looked up with ASOF joins; ratios are whole-number
arithmetic, so ties round as exact decimals do.
"""

from oracle.sql import q, tenths

PRODUCTS = (("05A1", "p05_1"), ("1A2", "p1_2"), ("2A3", "p2_3"), ("3A7", "p3_7"))
COUNTERS = ("total", *(c for _, c in PRODUCTS))
FLAG_ON = "COALESCE(m23, 0) = 1 OR COALESCE(m45, 0) = 1"


def growth(shifts: str) -> str:
    """``growth(report_date, shift, <counters>)``: what each counter grew from a shift's start to its end,
    a missing value being 0 and a fall no growth."""
    def at(edge: str) -> str:
        values = ", ".join(f"COALESCE(c.last.{x}, 0) AS {x}" for x in COUNTERS)
        return f"""
    SELECT s.report_date, s.shift, {values}
    FROM {shifts} s ASOF LEFT JOIN instants c ON s.{edge} >= c.ts"""
    whole = ", ".join(f"'{x}': {x}" for x in ("id", *COUNTERS))
    grown = ", ".join(f"GREATEST(b.{x} - a.{x}, 0) AS {x}" for x in COUNTERS)
    return f"""
instants AS (SELECT ts, max({{{whole}}}) AS last FROM counters GROUP BY ts),
growth AS (
  SELECT a.report_date, a.shift, {grown}
  FROM ({at("start_ts")}) a JOIN ({at("end_ts")}) b USING (report_date, shift)
)"""


def by_product(rest: str) -> str:
    """The growth of each product as rows (report_date, shift, produto, kg), and then ``rest`` of their columns."""
    rows = "\n    UNION ALL ".join(f"SELECT report_date, shift, '{label}' AS produto, {c} AS kg FROM growth" for label, c in PRODUCTS)
    return f"""
product_kg AS (
    {rows}
),
{rest}"""


GRANULATE_BY_PRODUCT = q("""
SELECT report_date, COALESCE(produto, 'Total') AS produto,
       CAST(kg1 AS BIGINT) AS t1_22_06, CAST(kg2 AS BIGINT) AS t2_06_14, CAST(kg3 AS BIGINT) AS t3_14_22,
       CAST(kg AS BIGINT) AS total_kg,
       CASE WHEN produto IS NOT NULL THEN
            CASE WHEN day_kg > 0 THEN CAST((200 * kg + day_kg) // (2 * day_kg) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS percentagem
FROM (SELECT *, max(kg) OVER (PARTITION BY report_date) AS day_kg FROM sums)""",
    growth("cal_shifts") + "," + by_product("""
sums AS (
  SELECT report_date, produto, sum(kg) AS kg, sum(kg) FILTER (WHERE shift = 1) AS kg1,
         sum(kg) FILTER (WHERE shift = 2) AS kg2, sum(kg) FILTER (WHERE shift = 3) AS kg3
  FROM product_kg GROUP BY GROUPING SETS ((report_date, produto), (report_date))
)"""))

GRANULATE_CURRENT = q("""
SELECT report_date, COALESCE(produto, 'Total') AS produto, CAST(kg AS BIGINT) AS atual_00_08 FROM sums""",
    growth("cur_shift") + "," + by_product("""
sums AS (SELECT report_date, produto, sum(kg) AS kg FROM product_kg
         GROUP BY GROUPING SETS ((report_date, produto), (report_date)))"""))


def state_time(shifts: str) -> str:
    """``held(report_date, shift, ts, flag, any_state, us)`` of each distinct status sample of a shift, and
    their sums ``time_by_shift``.

    A status holds to the next status, at most to the end of the shift; the
    state of every silo at its instant is the silo's latest sample.
    """
    return f"""
status AS (
  SELECT ts, flag, lead(ts) OVER (ORDER BY ts, flag) AS until
  FROM (SELECT DISTINCT ts, CAST({FLAG_ON} AS INTEGER) AS flag FROM remill)
),
silo_instants AS (
  SELECT silo_id, ts, max({{'id': id, 'state': state}}) AS last
  FROM silos_b WHERE silo_id BETWEEN 6 AND 10 GROUP BY ALL
),
emptying AS (
  SELECT p.ts, bool_or(COALESCE(i.last.state, 0) = 2) AS busy
  FROM (SELECT DISTINCT s.ts, n.silo_id FROM status s, (SELECT DISTINCT silo_id FROM silo_instants) n) p
  ASOF LEFT JOIN silo_instants i ON p.silo_id = i.silo_id AND p.ts >= i.ts
  GROUP BY p.ts
),
held AS (
  SELECT w.report_date, w.shift, s.ts, s.flag, CAST(COALESCE(e.busy, FALSE) AS INTEGER) AS any_state,
         epoch_us(LEAST(COALESCE(s.until, w.end_ts), w.end_ts)) - epoch_us(s.ts) AS us
  FROM {shifts} w JOIN status s ON s.ts >= w.start_ts AND s.ts < w.end_ts
  LEFT JOIN emptying e ON e.ts = s.ts
),
time_by_shift AS (
  SELECT w.report_date, w.shift,
         CAST(COALESCE(sum(us) FILTER (WHERE flag = 1 AND any_state = 1), 0) AS BIGINT) AS prod_us,
         CAST(COALESCE(sum(us) FILTER (WHERE flag = 1 AND any_state = 0), 0) AS BIGINT) AS idle_us,
         CAST(COALESCE(sum(us) FILTER (WHERE flag = 0), 0) AS BIGINT) AS off_us
  FROM {shifts} w LEFT JOIN held h USING (report_date, shift)
  GROUP BY ALL
)"""


PLANNED_US = 28_800_000_000
LABELS = ("Performance", "Disponibilidade", "OEE", "Tempo Trabalho sem granulado", "Tempo Secção Desligada")


def indicators(kg: str, prod: str, idle: str, off: str, shifts: int) -> list[str]:
    """The five indicators of a shift (or of ``shifts`` shifts together)."""
    planned = f"CAST({shifts * PLANNED_US} AS HUGEINT)"
    worked = f"GREATEST({planned} - {idle}, 0)"
    made, could = f"(100 * 3600000000::HUGEINT * {kg})", f"(1250 * CAST({prod} AS HUGEINT))"
    seconds = [f"CAST((2 * {x} + 1000000) // 2000000 AS DOUBLE)" for x in (idle, off)]
    return [tenths(made, could), tenths(f"(100 * {worked})", planned), tenths(f"({made} * {worked})", f"({could} * {planned})"), *seconds]


CALIBRATION_OEE = q("\nUNION ALL\n".join(
    f"""SELECT report_date, '{label}' AS indicador, {cells[0][i]} AS t1_22_06, {cells[1][i]} AS t2_06_14,
       {cells[2][i]} AS t3_14_22, {cells[3][i]} AS dia FROM day"""
    for cells in [[indicators(f"kg[{k}]", f"prod[{k}]", f"idle[{k}]", f"off[{k}]", 1) for k in (1, 2, 3)]
                  + [indicators("list_sum(kg)", "list_sum(prod)", "list_sum(idle)", "list_sum(off)", 3)]]
    for i, label in enumerate(LABELS)), growth("cal_shifts") + "," + state_time("cal_shifts") + """,
day AS (
  SELECT report_date, list(CAST(g.total AS HUGEINT) ORDER BY shift) AS kg, list(CAST(prod_us AS HUGEINT) ORDER BY shift) AS prod,
         list(CAST(idle_us AS HUGEINT) ORDER BY shift) AS idle, list(CAST(off_us AS HUGEINT) ORDER BY shift) AS off
  FROM time_by_shift t JOIN growth g USING (report_date, shift)
  GROUP BY report_date
)""")

CALIBRATION_OEE_CURRENT = q("\nUNION ALL\n".join(
    f"SELECT report_date, '{label}' AS indicador, {cell} AS atual_00_08 FROM now_shift"
    for label, cell in zip(LABELS, indicators("kg", "prod", "idle", "off", 1))), growth("cur_shift") + "," + state_time("cur_shift") + """,
now_shift AS (
  SELECT report_date, CAST(g.total AS HUGEINT) AS kg, CAST(prod_us AS HUGEINT) AS prod,
         CAST(idle_us AS HUGEINT) AS idle, CAST(off_us AS HUGEINT) AS off
  FROM time_by_shift t JOIN growth g USING (report_date, shift)
)""")

QUERIES = {
    "granulate_by_product": GRANULATE_BY_PRODUCT,
    "granulate_current": GRANULATE_CURRENT,
    "calibration_oee": CALIBRATION_OEE,
    "calibration_oee_current": CALIBRATION_OEE_CURRENT,
}
