"""Registered queries: name -> plan over (tables, scope).

Each plan returns one DataFrame keyed by ``report_date`` (plus a row key
for table-shaped results).  ``__spark_entry__`` binds them to the fixture
tables; production code binds them to ``read_tables`` and a ``Scope``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shiftmetrics.plans import activity, blocks, calibration, disinfection, grinding, opcalendar

Plan = Callable[..., DataFrame]

REPORT_QUERIES: dict[str, Plan] = {
    "report_activity": activity.report_activity,                         # Q01
    "md_runtime": grinding.md_runtime,                                   # Q02
    "mill_hours": grinding.mill_hours,                                   # Q03
    "silo_kg_grinding": grinding.silo_kg_grinding,                       # Q04
    "grinding_oee": grinding.grinding_oee,                               # Q05
    "silo_total_8h_grinding": grinding.silo_total_8h_grinding,           # Q06
    "silo_kg_disinfection": grinding.silo_kg_disinfection,               # Q07
    "silo_total_8h_disinfection": grinding.silo_total_8h_disinfection,   # Q08
    "silo_snapshot_vinc": grinding.silo_snapshot_vinc,                   # Q13
    "md_runtime_current": grinding.md_runtime_current,                   # Q14
    "mill_hours_current": grinding.mill_hours_current,                   # Q15
    "silo_kg_grinding_current": grinding.silo_kg_grinding_current,       # Q16
    "silo_kg_disinfection_current": grinding.silo_kg_disinfection_current,  # Q17
    "granulate_by_product": calibration.granulate_by_product,            # Q09
    "calibration_oee": calibration.calibration_oee,                      # Q11
    "granulate_current": calibration.granulate_current,                  # Q18
    "calibration_oee_current": calibration.calibration_oee_current,      # Q19
    "disinfections_vinc": disinfection.disinfections_vinc,               # Q10
    "disinfections_grinding": disinfection.disinfections_grinding,       # Q12
    "disinfections_grinding_current": disinfection.disinfections_grinding_current,  # Q20
    "disinfections_vinc_current": disinfection.disinfections_vinc_current,          # Q21
}

BLOCK_QUERIES: dict[str, Plan] = {
    "shift_grid_day": blocks.shift_grid_day,                             # B3
    "shift_grid_calibration": blocks.shift_grid_calibration,             # B4
    "window_clamp": blocks.window_clamp,                                 # B6
    "carry_in_latest": blocks.carry_in_latest,                           # J1
    "counter_asof": blocks.counter_asof,                                 # J2
    "segment_durations": blocks.segment_durations,                       # J6
    "state_sweep": blocks.state_sweep,                                   # J5 (rows)
    "calibration_state_time": blocks.calibration_state_time_q,           # J5
    "cycle_islands": blocks.cycle_islands,                               # J8
    "operational_calendar": opcalendar.calendar_query,                   # B9-B14, B16
    "report_days": opcalendar.report_days_query,                         # B15
}

ALL_QUERIES: dict[str, Plan] = {**REPORT_QUERIES, **BLOCK_QUERIES}

from shiftmetrics.plans import report as _report  # noqa: E402

MART_QUERIES: dict[str, Plan] = {
    "format_values": _report.granulate_cells,                            # K3, I13, I14
    "status_thresholds": _report.calibration_oee_cells,                  # K4, I12, I15, I16
    "report_cells": _report.report_cells,                                # K1-K7
}
ALL_QUERIES.update(MART_QUERIES)
