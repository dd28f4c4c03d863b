"""The daily report run (reference's main loop, section 3.1) as Spark jobs.

``daily_run``: at ``as_of``, the report date is the previous local calendar
day (B13); it is produced only when ready (D+1 08:15 local, B14) and when
the date is operational or had activity (B15).  ``backfill`` does the same
for a range of dates.  The dates are selected first; runs of consecutive
dates are then computed in one pass each and written beside what is published.
At the end one manifest makes them visible and takes out the reports of dates that
are not to be sent, so a rerun leaves what a first run would, and a run that
breaks off anywhere leaves the reports as they were.

Every report must have all its blocks (K7).  A run of dates that fails, or
lacks blocks, is repeated date by date: the other dates are written, and
``ReportErrors`` names the dates that were not.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from shiftmetrics.config import DEFAULT_CONFIG, Config
from shiftmetrics.plans.activity import report_activity
from shiftmetrics.plans.facts import FactStore, consecutive
from shiftmetrics.plans.opcalendar import operational_calendar, report_days
from shiftmetrics.plans.report import publish, read_runs, report_cells, write_run
from shiftmetrics.plans.scope import Scope
from shiftmetrics.session import ensure_checkpoint_dir
from shiftmetrics.sources.prior import cutoff_for, prior_for_run, with_prior
from shiftmetrics.sources.tables import SensorTables


class IncompleteReport(Exception):
    """A report without all its blocks."""


class ReportErrors(Exception):
    """What went wrong, by report date; all other dates were written."""

    def __init__(self, errors: dict[date, Exception]):
        super().__init__("; ".join(f"{d}: {e}" for d, e in sorted(errors.items())))
        self.errors = errors


def report_date_for(as_of: datetime, tz: str = DEFAULT_CONFIG.tz) -> date:
    """Previous local calendar day of ``as_of``."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return as_of.astimezone(ZoneInfo(tz)).date() - timedelta(days=1)


def selected_dates(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> dict[date, tuple[bool, bool]]:
    """Each report date of the scope: whether it is to be sent, and whether it is ready (a row a day)."""
    sel = report_days(operational_calendar(scope, t.holidays, cfg), report_activity(t, scope, cfg),
                      scope.as_of)
    rows = sel.select("report_date", "send", "is_ready").collect()
    return {r["report_date"]: (bool(r["send"]), bool(r["is_ready"])) for r in rows}


def backfill(spark: SparkSession, t: SensorTables, first: date, last: date, out_path: str,
             as_of: datetime | None = None, cfg: Config = DEFAULT_CONFIG,
             state_dir: str | None = None, facts_dir: str | None = None) -> DataFrame:
    """Produce and write the reports of ``first..last`` (those to be sent); returns their cells.

    With ``state_dir`` (a shared folder), unbounded as-of inputs read a
    stored prior plus recent rows instead of their whole history.  With
    ``facts_dir`` (another one), final facts of the mart are kept by date and
    computed again only after late rows (``FactStore.forget``).
    """
    scope = Scope.for_range(spark, first, last, as_of=as_of, tz=cfg.tz)
    if state_dir is not None:
        cut = cutoff_for(first, cfg.tz)
        t = with_prior(t, prior_for_run(spark, t, state_dir, cut), cut)
    selected = selected_dates(t, scope, cfg)
    ensure_checkpoint_dir(spark)
    store = FactStore(spark, facts_dir, cfg) if facts_dir is not None else None
    written: dict[date, int] = {}
    errors: dict[date, Exception] = {}

    def produce(a: date, b: date) -> None:
        dates = [a + timedelta(days=k) for k in range((b - a).days + 1)]
        cells = report_cells(t, Scope.for_range(spark, a, b, as_of=as_of, tz=cfg.tz), cfg, store=store)
        n, missing = write_run(cells, out_path, dates)
        if missing:
            raise IncompleteReport("blocks are missing on " + ", ".join(map(str, missing)))
        written.update(dict.fromkeys(dates, n))

    for a, b in consecutive([d for d, (send, is_ready) in selected.items() if send and is_ready]):
        try:
            produce(a, b)
        except (PySparkException, IncompleteReport) as e:
            if a == b:
                errors[a] = e
                continue
            for k in range((b - a).days + 1):
                d = a + timedelta(days=k)
                try:
                    produce(d, d)
                except (PySparkException, IncompleteReport) as day_error:
                    errors[d] = day_error
    # A date that is not ready yet keeps the report it has.
    dropped = [d for d, (send, _) in selected.items() if not send]
    if written or dropped:
        publish(spark, out_path, written, dropped)
    if errors:
        raise ReportErrors(errors)
    return read_runs(spark, out_path, written)


def daily_run(spark: SparkSession, t: SensorTables, out_path: str, as_of: datetime | None = None,
              cfg: Config = DEFAULT_CONFIG, state_dir: str | None = None, facts_dir: str | None = None) -> DataFrame:
    """The scheduled run: yesterday's report if it is ready and to be sent."""
    as_of = as_of or datetime.now(timezone.utc)
    d = report_date_for(as_of, cfg.tz)
    return backfill(spark, t, d, d, out_path, as_of=as_of, cfg=cfg, state_dir=state_dir, facts_dir=facts_dir)
