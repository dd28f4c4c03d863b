"""As-of index: the last row of every entity and day, so that runs need not scan history.

Counters, silo weights and silo states are read "as of" instants with
unbounded lookback: the answer may be a sample of any age.  Scanning the
whole history on every run does not scale, so a run reads only ``prior ∪
rows with ts >= cutoff`` — a ``ts`` bound pushed to the scan — where the *prior*
holds the latest row per entity (and per row filter, e.g. "latest non-NULL
total" for the activity steps) before the ``cutoff``.

This is exact as long as every instant the run looks up is at or after the
cutoff: the latest row before any such instant is either a recent row or
the prior row.  ``cutoff_for`` keeps a day of margin before the first
report date (the earliest instant any plan reads is 14 h before it) and lies at
midnight UTC.

The prior of any cutoff comes from a stored index: the latest row per (row
filter, entity, UTC day), at most a few rows a day and entity.  Its rows of
days before the cutoff are all that is needed.  The index grows by ingests,
numbered folders (``versions``): a run adds the days between what is covered
and its cutoff, late rows add the days they touch, and the later row of a day
wins when the index is read.  So backfills of old dates and late rows read
no history, and an ingest that breaks off leaves the index as it was.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, time, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftmetrics.config import LOCAL_TZ
from shiftmetrics.plans.scope import within
from shiftmetrics.sources import versions
from shiftmetrics.sources.tables import SensorTables

# table -> (entity keys, row filters whose latest row must be kept)
UNBOUNDED = {
    "counters": ([], [None, "total IS NOT NULL"]),
    "silos_a": (["silo_id"], [None]),
    "silos_b": (["silo_id"], [None]),
    "silos_c": (["silo_id"], [None]),
}
MARGIN = timedelta(days=1)


def cutoff_for(first: date, tz: str = LOCAL_TZ) -> datetime:
    """The last midnight UTC that lies a day before local midnight of ``first``."""
    loc = datetime.combine(first, time()).replace(tzinfo=ZoneInfo(tz))
    utc = loc.astimezone(timezone.utc).replace(tzinfo=None) - MARGIN
    return datetime.combine(utc.date(), time())


def _latest_rows(df: DataFrame, keys: list[str], filters: list[str | None]) -> DataFrame:
    cols = df.columns
    parts = []
    for f in filters:
        src = df if f is None else df.filter(F.expr(f))
        rec = F.struct(*[F.col(c) for c in cols])
        parts.append(src.groupBy(*keys).agg(F.max_by(rec, F.struct("ts", "id")).alias("r"))
                     .select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts).dropDuplicates(["ts", "id", *keys])


def build_prior(t: SensorTables, cutoff: datetime) -> dict[str, DataFrame]:
    """Latest rows before ``cutoff`` of every unbounded-lookback table (full scan, once)."""
    out = {}
    for name, (keys, filters) in UNBOUNDED.items():
        df = getattr(t, name)
        out[name] = _latest_rows(within(df, before=cutoff), keys, filters)
    return out


def advance_prior(prior: dict[str, DataFrame], t: SensorTables, old: datetime,
                  new: datetime) -> dict[str, DataFrame]:
    """Prior at ``new`` from the prior at ``old`` and the rows in ``[old, new)``."""
    out = {}
    for name, (keys, filters) in UNBOUNDED.items():
        df = getattr(t, name)
        recent = within(df, lo=old, before=new)
        out[name] = _latest_rows(prior[name].unionByName(recent), keys, filters)
    return out


def with_prior(t: SensorTables, prior: dict[str, DataFrame], cutoff: datetime) -> SensorTables:
    """Tables whose unbounded-lookback inputs read ``prior ∪ (ts >= cutoff)``."""
    repl = {}
    for name in UNBOUNDED:
        df = getattr(t, name)
        repl[name] = prior[name].unionByName(within(df, lo=cutoff))
    return replace(t, **repl)


#: Ingests that are read one by one; then they are merged into one.
MOST_INGESTS = 32
_META = "covered timestamp_ntz, base boolean"


def _index_rows(df: DataFrame, keys: list[str], filters: list[str | None]) -> DataFrame:
    """The latest row per (row filter, entity, UTC day)."""
    rec = F.struct(*[F.col(c) for c in df.columns])
    day = F.col("ts").cast("date").alias("_day")
    parts = []
    for k, f in enumerate(filters):
        src = df if f is None else df.filter(F.expr(f))
        parts.append(src.groupBy(F.lit(k).alias("_filter"), day, *keys).agg(F.max_by(rec, F.struct("ts", "id")).alias("r"))
                     .select("_filter", "_day", "r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _ingests(spark: SparkSession, state_dir: str) -> tuple[list[int], datetime | None]:
    """The ingests that make up the index (from the last merged one on), and up to where it covers the tables."""
    numbers = versions.ready(spark, state_dir)
    if not numbers:
        return [], None
    meta = spark.read.schema("n int, " + _META).option("basePath", state_dir).parquet(
        *[f"{versions.folder(state_dir, n)}/meta" for n in numbers]).withColumn(
        "n", F.regexp_extract(F.input_file_name(), r"/n=(\d+)/meta/", 1).cast("int")).collect()
    first = max((r["n"] for r in meta if r["base"]), default=0)
    return [n for n in numbers if n >= first], max(r["covered"] for r in meta)


def _ingest(spark: SparkSession, state_dir: str, rows: dict[str, DataFrame], covered: datetime, base: bool) -> None:
    n = versions.begin(spark, state_dir)
    for name, df in rows.items():
        df.coalesce(1).write.parquet(f"{versions.folder(state_dir, n)}/{name}")
    spark.createDataFrame([(covered, base)], _META).coalesce(1).write.parquet(f"{versions.folder(state_dir, n)}/meta")
    versions.finish(spark, state_dir, n)


def _read_index(spark: SparkSession, state_dir: str, numbers: list[int], name: str) -> DataFrame | None:
    """The index of a table (None where no ingest holds it): of a day's rows the latest."""
    keys, _ = UNBOUNDED[name]
    parts = []
    for n in numbers:
        if name in versions.names(spark, state_dir, n):
            parts.append(spark.read.parquet(f"{versions.folder(state_dir, n)}/{name}"))
    if not parts:
        return None
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    newest = Window.partitionBy("_filter", "_day", *keys).orderBy(F.desc("ts"), F.desc("id"))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def stored_cutoff(spark: SparkSession, state_dir: str) -> datetime | None:
    """Up to where the stored index covers the tables; None if nothing is stored."""
    return _ingests(spark, state_dir)[1]


def absorb_late(spark: SparkSession, state_dir: str, table: str, rows: DataFrame) -> None:
    """Take rows that arrived after their days were indexed up into the index.

    Runs never read the history before their cutoff again, so whoever adds late
    rows to a table passes them here (``refresh_on_arrival`` does).  Only the
    days of these rows are written, as an ingest of their own.
    """
    numbers, covered = _ingests(spark, state_dir)
    if covered is None or table not in UNBOUNDED:
        return
    keys, filters = UNBOUNDED[table]
    columns = [c for c in _read_index(spark, state_dir, numbers, table).columns if c not in ("_filter", "_day")]
    late = _index_rows(within(rows, before=covered).select(*columns), keys, filters)
    _ingest(spark, state_dir, {table: late}, covered, base=False)


def compact(spark: SparkSession, state_dir: str) -> None:
    """Merge all ingests into one and remove them; what is read before and after is the same."""
    numbers, covered = _ingests(spark, state_dir)
    if len(numbers) > 1:
        _ingest(spark, state_dir, {name: _read_index(spark, state_dir, numbers, name) for name in UNBOUNDED}, covered, base=True)
        versions.drop(spark, state_dir, numbers)


def prior_for_run(spark: SparkSession, t: SensorTables, state_dir: str,
                  cutoff: datetime) -> dict[str, DataFrame]:
    """The prior at ``cutoff``, from the index in ``state_dir`` (a shared folder).

    The tables are read from where the index ends up to a later cutoff, their
    whole history only the first time; an earlier cutoff (a backfill of old
    dates) reads the index alone.
    """
    if cutoff != datetime.combine(cutoff.date(), time()):
        raise ValueError("a cutoff lies at midnight UTC")
    numbers, covered = _ingests(spark, state_dir)
    if covered is None or covered < cutoff:
        rows = {name: _index_rows(within(getattr(t, name), lo=covered, before=cutoff), keys, filters)
                for name, (keys, filters) in UNBOUNDED.items()}
        _ingest(spark, state_dir, rows, cutoff, base=covered is None)
        numbers, covered = _ingests(spark, state_dir)
    if len(numbers) > MOST_INGESTS:
        compact(spark, state_dir)
        numbers, covered = _ingests(spark, state_dir)
    out = {}
    for name, (keys, filters) in UNBOUNDED.items():
        index = _read_index(spark, state_dir, numbers, name).filter(F.col("_day") < F.lit(cutoff.date()))
        parts = [_latest_rows(index.filter(F.col("_filter") == k).drop("_filter", "_day"), keys, [None]) for k in range(len(filters))]
        out[name] = reduce(lambda a, b: a.unionByName(b), parts).dropDuplicates(["ts", "id", *keys])
    return out
