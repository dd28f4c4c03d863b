"""Which report dates to compute, and what "now" is.

A ``Scope`` carries the set of report dates as a small DataFrame (one row
per calendar day, so at most 366 rows per year of span; it is the only
relation that is ever broadcast) and the ``as_of`` instant that clamps
running shifts (the reference's ``now()``).

When the scope is built from explicit Python dates, literal timestamp bounds
are also known; operators add them as plain filters on ``ts`` so they reach
the Parquet scan as ``PushedFilters`` (bounds that arrive through a join do
not push down).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.config import LOCAL_TZ
from shiftmetrics.functions.timegrid import to_local


#: The column of a sample table that is partitioned by the UTC date of its rows' ``ts``.
DATE_PARTITION = "ts_date"


def ntz_literal(ts: datetime) -> Column:
    """A ``timestamp_ntz`` literal that no session or process zone can shift."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Scope:
    dates: DataFrame                 # column ``report_date`` (DATE)
    as_of: Column | None             # UTC instant (NTZ); None = no clamp
    first: date | None = None        # literal bounds, when known
    last: date | None = None
    tz: str = LOCAL_TZ
    now: datetime | None = None      # ``as_of`` as a value, when known

    # -- constructors ---------------------------------------------------------
    @classmethod
    def for_range(cls, spark: SparkSession, first: date, last: date,
                  as_of: datetime | None = None, tz: str = LOCAL_TZ) -> "Scope":
        """Report dates ``first..last``; ``as_of`` defaults to the current time."""
        n = (last - first).days + 1
        if n <= 0:
            raise ValueError(f"the last date {last} lies before the first date {first}")
        if as_of is None:
            as_of = datetime.now(timezone.utc)
        if getattr(as_of, "tzinfo", None) is not None:
            as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
        dates = (spark.range(n)
                 .select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("report_date")))
        return cls(dates, ntz_literal(as_of), first, last, tz, as_of)

    @classmethod
    def spanning(cls, samples: DataFrame, ts: str = "ts", tz: str = LOCAL_TZ) -> "Scope":
        """Every local date touched by ``samples``; "now" is their latest instant.

        One global aggregate (three scalars, partially aggregated per task)
        fixes the span; the scope is then literal, so its timestamp bounds
        reach the Parquet scans as pushed filters and no plan recomputes
        the span.
        """
        loc = to_local(F.col(ts), tz)
        row = samples.agg(F.min(loc).cast("date").alias("lo"), F.max(loc).cast("date").alias("hi"),
                          F.max(ts).alias("now")).first()
        if row is None or row["lo"] is None:
            raise ValueError("no samples to span")
        return cls.for_range(samples.sparkSession, row["lo"], row["hi"], as_of=row["now"], tz=tz)

    # -- helpers --------------------------------------------------------------
    def date_dim(self) -> DataFrame:
        return F.broadcast(self.dates.select("report_date"))

    def keep(self, df: DataFrame, col: str = "report_date") -> DataFrame:
        """Rows of ``df`` whose ``col`` is a report date.

        A literal scope is a contiguous range, so this is a plain range
        predicate; otherwise a broadcast semi join with the date dimension.
        """
        if self.first is not None and self.last is not None:
            return df.filter(F.col(col).between(F.lit(self.first), F.lit(self.last)))
        keys = self.date_dim()
        if col != "report_date":
            keys = keys.withColumnRenamed("report_date", col)
        return df.join(keys, col, "left_semi")

    def _instant(self, d: date, offset: timedelta) -> datetime:
        loc = datetime.combine(d, time()) + offset
        return loc.replace(tzinfo=ZoneInfo(self.tz)).astimezone(timezone.utc).replace(tzinfo=None)

    def _bounds(self, lo: timedelta | None, hi: timedelta | None, days: str = "all") -> tuple[datetime | None, datetime | None]:
        """Instants ``lo`` before the first and ``hi`` after the last local midnight (``days="first"``: of the
        first date), an hour wider on both sides; None where open or unknown."""
        if self.first is None or self.last is None:
            return None, None
        hour = timedelta(hours=1)
        end = self.first if days == "first" else self.last
        return (None if lo is None else self._instant(self.first, -lo - hour),
                None if hi is None else self._instant(end, hi + hour))

    def instants(self, lo: timedelta, hi: timedelta) -> tuple[Column | None, Column | None]:
        """The bounds of ``clip`` as literals (None where the scope is not literal)."""
        a, b = self._bounds(lo, hi)
        return (None if a is None else ntz_literal(a)), (None if b is None else ntz_literal(b))

    def clip(self, df: DataFrame, lo: timedelta | None, hi: timedelta | None, days: str = "all") -> DataFrame:
        """Rows of a sample table around the scope, by literal bounds (all rows when unknown).

        ``lo`` is how far before local midnight of the first date data is
        needed (``None`` = unbounded history), ``hi`` how far after local
        midnight of the last date.  The bounds on ``ts`` reach the Parquet
        scan; where the table is partitioned by date (``DATE_PARTITION``), its
        folders are pruned by the same bounds.
        """
        return within(df, *self._bounds(lo, hi, days))


def within(df: DataFrame, lo: datetime | None = None, hi: datetime | None = None, before: datetime | None = None) -> DataFrame:
    """Rows with ``lo <= ts <= hi`` and ``ts < before``, and the date partitions that can hold them."""
    parted = DATE_PARTITION in df.columns
    for bound, keep in ((lo, lambda c, x: c >= x), (hi, lambda c, x: c <= x)):
        if bound is not None:
            df = df.filter(keep(F.col("ts"), ntz_literal(bound)))
            if parted:
                df = df.filter(keep(F.col(DATE_PARTITION), F.lit(bound.date())))
    if before is not None:
        df = df.filter(F.col("ts") < ntz_literal(before))
        if parted:
            df = df.filter(F.col(DATE_PARTITION) <= F.lit(before.date()))
    return df


def next_day(scope: Scope) -> Scope:
    """The scope of the following days: report date D maps to D + 1.

    Used by the "current" (``Atual 00-08``) metrics, which are shift 1 of the
    day after the report date.
    """
    dates = scope.dates.select(F.date_add("report_date", 1).alias("report_date"))
    one = timedelta(days=1)
    return Scope(dates, scope.as_of,
                 scope.first + one if scope.first else None,
                 scope.last + one if scope.last else None, scope.tz, scope.now)


def with_dates(scope: Scope, facts: DataFrame) -> DataFrame:
    """The scope's ``facts`` and, for every report date, a row with nothing else: grouped by date, no date is missing."""
    return scope.keep(facts).unionByName(scope.dates.select("report_date"), allowMissingColumns=True)


def extended(scope: Scope, days: int = 1) -> Scope:
    """The scope plus the ``days`` following dates (literal scopes only)."""
    if scope.first is None or scope.last is None:
        raise ValueError("only a literal scope can be extended")
    spark = scope.dates.sparkSession
    last = scope.last + timedelta(days=days)
    n = (last - scope.first).days + 1
    dates = spark.range(n).select(F.date_add(F.lit(scope.first), F.col("id").cast("int")).alias("report_date"))
    return Scope(dates, scope.as_of, scope.first, last, scope.tz, scope.now)
