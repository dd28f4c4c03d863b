"""Time chunks: how every sample-level window is split, and how chunks are put together again.

A window over a whole group (one silo during one shift) is one huge task if
that group carries a large share of all rows.  So windows run per
``(group keys, chunk)``, where the chunk is a slice of time (an hour by default),
and each chunk is reduced in the same stage to one small record: its first
and last row and what happened in between.  The records of a group, in order,
are then merged by a window over these few rows, which adds what happens
from the last row of one chunk to the first row of the next.  Rows are read
and shuffled once, and nothing is joined back to them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plans pass ``Config.window_chunk``; tests use one minute, so that chunk
# edges fall between most neighbouring rows.
DEFAULT_CHUNK = timedelta(hours=1)


def width_us(width: timedelta) -> int:
    return int(width / timedelta(microseconds=1))


def micros(ts: str | Column = "ts") -> Column:
    """Microseconds of an instant (NTZ, zone-free) since 1970."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def time_chunk(ts: str | Column = "ts", width: timedelta = DEFAULT_CHUNK) -> Column:
    """Index of the ``width`` time slice holding ``ts``."""
    us = width_us(width)
    return F.floor(micros(ts) / F.lit(us)).cast("long")
