"""Domain configuration.

The values in ``Config`` defaults are fixed values: they must equal the
reference report for identical results.  They are gathered here, in natural
order; block titles stand with the report's layout (``plans/report.py``) and
the VINC silo columns with their query, marked as fixed values there.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

# --- fixed values (must equal the reference) --------------------------------
LOCAL_TZ = "Europe/Lisbon"

# Shift labels of the day grid (00-08 / 08-16 / 16-24) and the calibration
# grid (22-06 / 06-14 / 14-22), and the label of the following day's
# first shift.
DAY_SHIFT_LABELS = ("T1(00-08)", "T2(08-16)", "T3(16-24)")
CAL_SHIFT_LABELS = ("T1(22-06)", "T2(06-14)", "T3(14-22)")
CURRENT_LABEL = "Atual 00-08"

# Calibration products: label -> counter column.
PRODUCTS = (("05A1", "p05_1"), ("1A2", "p1_2"), ("2A3", "p2_3"), ("3A7", "p3_7"))
PRODUCT_TOTAL_LABEL = "Total"

# Disinfection machines: VINC line uses machines 1-4, grinding line 5-9.
VAPEX_VINC = (1, 2, 3, 4)
VAPEX_GRINDING = (5, 6, 7, 8, 9)
VAPEX_TOTAL_LABEL = "TOTAL"

# Machine states that count as activity.
ACTIVE_MACHINE_STATES = ("Funcionamento", "Carga", "Descarga")

# Calibration OEE indicator rows, in display order.
IND_PERFORMANCE = "Performance"
IND_AVAILABILITY = "Disponibilidade"
IND_OEE = "OEE"
IND_IDLE = "Tempo Trabalho sem granulado"
IND_OFF = "Tempo Secção Desligada"
CAL_INDICATORS = (IND_PERFORMANCE, IND_AVAILABILITY, IND_OEE, IND_IDLE, IND_OFF)

# VINC silo snapshot columns (silo id -> column label).
VINC_SILOS = (
    (1, "SILO 1: 3A7 CS"),
    (2, "SILO 2: 2A3 CS"),
    (3, "SILO 3: 1A2 CS"),
    (4, "SILO 4: 05A1 CS"),
    (5, "SILO 5: 1A2 VINC"),
    (6, "SILO 6: 05A1 VINC"),
)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Thresholds, rates and caps.  Defaults are the reference's values."""

    tz: str = LOCAL_TZ
    gap_cap: timedelta = timedelta(minutes=2)          # longest gap counted as running
    carry_lookback: timedelta = timedelta(hours=12)    # carry-in lookback
    grinding_rate_kg_h: float = 1450.0
    calibration_rate_kg_h: float = 1250.0
    planned_shift_s: int = 28800                       # planned calibration time per shift
    window_chunk: timedelta = timedelta(hours=1)       # time slice of a window task: changes task sizes, never results
    mill_freq_min: float = 1.0                         # screw counts as running when freq > this
    cycle_min_theoretical: int = 45                    # cycle counted when theoretical > this
    cycle_window_before: timedelta = timedelta(hours=12)
    cycle_window_after: timedelta = timedelta(hours=36)
    current_cycle_window_after: timedelta = timedelta(hours=20)
    snapshot_at: timedelta = timedelta(hours=8)        # silo snapshot D+1 08:00
    vinc_snapshot_at: timedelta = timedelta(hours=8, minutes=5)
    activity_min_kg: float = 10.0
    activity_counter_start: timedelta = timedelta(hours=6)   # counter day 06:00 -> 06:00
    activity_day_start: timedelta = timedelta(hours=8)       # flag day 08:00 -> 08:00
    report_ready_at: timedelta = timedelta(hours=8, minutes=15)
    grinding_silos: tuple[int, int] = (1, 5)
    disinfection_silos: tuple[int, int] = (6, 10)
    vinc_silos: tuple[int, int] = (1, 6)
    mill_screws: tuple[int, ...] = (1, 2, 3, 4, 5)
    oee_ok: float = 80.0
    oee_warning: float = 70.0
    idle_bad_s: float = 5400.0
    idle_warning_s: float = 3600.0
    cycles_ok: int = 4


DEFAULT_CONFIG = Config()
