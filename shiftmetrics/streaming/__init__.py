"""Structured Streaming driver of the daily report run.

The reference is a batch report run once a day; it has no streaming
operators (no watermarks, stateful operators or event-time windows).  The
only streaming piece here re-aims its run loop at arriving data: a file
stream over one sensor table is used as the trigger, and each micro-batch
re-runs the batch plan for the report dates the new samples can change,
overwriting those mart partitions.
"""

from shiftmetrics.streaming.refresh import affected_dates, refresh_on_arrival

__all__ = ["affected_dates", "refresh_on_arrival"]
