"""Sensor-table readers (A1-A4) and fixture views."""

from shiftmetrics.sources.tables import SensorTables, read_tables

__all__ = ["SensorTables", "read_tables"]
