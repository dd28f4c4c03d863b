"""Number rounding and display formats.

Rounding follows the reference exactly:

* SQL ``ROUND`` and ``::int`` round half away from zero.  Where both operands
  are integers (microseconds, counts) the quotient is rounded with integer
  arithmetic, ``(2a + b) div 2b``, so no floating point is involved.
* Python's ``round`` in the report layer is half-to-even: ``bround``.

The helpers take SQL expression text and return one ``expr`` column, which
keeps plan construction cheap (one JVM call per expression instead of one
per operator).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_S = 1_000_000
US_PER_MIN = 60 * US_PER_S


def _e(sql: str) -> Column:
    return F.expr(sql)


def idiv_sql(a: str, b: str | int) -> str:
    """Floor division of non-negative integers."""
    return f"(({a}) div ({b}))"


def round_div_sql(a: str, b: str | int) -> str:
    """``round(a / b)`` half up for integers ``a >= 0``, ``b > 0``."""
    return f"((2 * ({a}) + ({b})) div (2 * ({b})))"


def round_div(a: str, b: str | int) -> Column:
    return _e(round_div_sql(a, b))


def milli(value: Column) -> Column:
    """A decimal quantity in thousandths, as a whole number."""
    return F.round(value.cast("decimal(24,3)") * 1000, 0).cast("decimal(18,0)")


def percent_tenths(part: Column, whole: Column) -> Column:
    """``round(100 * part / whole, 1)`` in tenths: exact for whole numbers, half up; 0 without a whole."""
    n, d = part.cast("decimal(38,0)"), whole.cast("decimal(38,0)")
    return F.when(d > 0, F.call_function("div", 2000 * n + d, 2 * d)).otherwise(F.lit(0).cast("long"))


def capped_percent(tenths: Column) -> Column:
    """Tenths as a percentage of at most 100."""
    return F.least(F.lit(1000).cast("long"), F.coalesce(tenths, F.lit(0).cast("long"))) / F.lit(10.0)


def rate_parts(kg: Column, work_us: Column, rate_kg_h: float) -> tuple[Column, Column]:
    """(made, possible) as whole numbers whose ratio is kg over what ``rate_kg_h`` gives in ``work_us``."""
    made = milli(kg) * F.lit(3600 * US_PER_S).cast("decimal(12,0)")
    return made, F.lit(round(rate_kg_h * 1000)).cast("decimal(10,0)") * work_us.cast("decimal(18,0)")


def hhmm_minutes_sql(m: str) -> str:
    """``to_char(make_interval(mins => m), 'HH24"h"MI')``; hours do not wrap."""
    return f"format_string('%02dh%02d', ({m}) div 60, pmod({m}, 60))"


def hhmm_seconds_sql(s: str) -> str:
    """``to_char(make_interval(secs => s), 'HH24hMI')``: seconds are dropped."""
    return f"format_string('%02dh%02d', ({s}) div 3600, pmod({s}, 3600) div 60)"


def runtime_text(run_us: str, load_us: str) -> Column:
    """``05h33 (49%)``: running minutes and loaded share of them."""
    minutes = round_div_sql(run_us, US_PER_MIN)
    pct = f"CASE WHEN ({run_us}) > 0 THEN {round_div_sql(f'({load_us}) * 100', run_us)} ELSE 0L END"
    return _e(f"concat({hhmm_minutes_sql(minutes)}, ' (', CAST({pct} AS STRING), '%)')")


def hours_text(work_us: str) -> Column:
    """``05h33`` from microseconds (seconds rounded, then minutes floored)."""
    return _e(hhmm_seconds_sql(round_div_sql(work_us, US_PER_S)))


def hhmmss(seconds: str) -> Column:
    """Seconds -> ``HH:MM:SS``; NULL -> 0; half-to-even."""
    s = f"CAST(bround(coalesce(CAST({seconds} AS DOUBLE), 0D), 0) AS BIGINT)"
    return _e(f"format_string('%02d:%02d:%02d', {s} div 3600, pmod({s}, 3600) div 60, pmod({s}, 60))")


def kg_text(kg: str) -> Column:
    """``10 425 kg``: integer, space thousands; NULL -> ``0 kg``."""
    n = f"CAST(bround(CAST({kg} AS DOUBLE), 0) AS BIGINT)"
    return _e(f"CASE WHEN ({kg}) IS NULL THEN '0 kg' "
              f"ELSE concat(regexp_replace(format_number({n}, 0), ',', ' '), ' kg') END")


def pct_text(p: str) -> Column:
    """``73.6 %``; NULL -> ``0 %`` (I14).  Inputs are already rounded to one
    decimal by the queries, so the text needs no further rounding."""
    return _e(f"CASE WHEN ({p}) IS NULL THEN '0 %' ELSE format_string('%.1f %%', CAST({p} AS DOUBLE)) END")


def oee_status(p: str, ok: float = 80.0, warning: float = 70.0) -> Column:
    """ok / warning / bad for an OEE percentage."""
    v = f"coalesce(CAST({p} AS DOUBLE), 0D)"
    return _e(f"CASE WHEN {v} >= {ok!r}D THEN 'ok' WHEN {v} >= {warning!r}D THEN 'warning' ELSE 'bad' END")


def idle_status(s: str, bad: float = 5400.0, warning: float = 3600.0) -> Column:
    """bad / warning / ok for idle seconds (I16)."""
    v = f"coalesce(CAST({s} AS DOUBLE), 0D)"
    return _e(f"CASE WHEN {v} >= {bad!r}D THEN 'bad' WHEN {v} >= {warning!r}D THEN 'warning' ELSE 'ok' END")


def cycles_status(n: str, ok: int = 4) -> Column:
    """ok when at least ``ok`` disinfection cycles, else bad."""
    return _e(f"CASE WHEN coalesce({n}, 0) >= {ok} THEN 'ok' ELSE 'bad' END")
