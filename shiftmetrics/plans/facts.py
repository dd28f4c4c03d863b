"""The facts that the report mart is derived from, and a store of them by fact and date (K1).

A fact is a small table per report date (a few rows a shift), computed from
the sensor tables it names.  The report of date D reads the facts of D to
D + ``ahead``.  Facts of one date do not depend on what other dates are
computed with them.

The store keeps facts between runs: ``<root>/config=<digest>/ingests/n=<k>/<fact>/fact_date=<d>``
holds what run k wrote, and a manifest says which ingest holds a fact of a date
and at which "now" it was computed.  A run computes what is not stored (dates
that follow each other in one pass), writes it and publishes it in one step;
whoever adds late rows to a table takes the facts of that table and of the
dates they touch out (``forget``), so that the next run computes those alone.

A stored fact is used once it is final: until ``FINAL`` after its date's local
midnight, rows that are not there yet belong to it, and every run computes it
anew.  One writer at a time; a run that breaks off leaves the manifest, and so
all that is read, as it was.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.config import DEFAULT_CONFIG, VAPEX_GRINDING, VAPEX_VINC, Config
from shiftmetrics.functions.timegrid import cell_report_date, cell_shift_of
from shiftmetrics.operators.sweep import CLASSES, GRIDS
from shiftmetrics.plans import calibration, disinfection, grinding
from shiftmetrics.plans.scope import Scope, extended
from shiftmetrics.sources import versions
from shiftmetrics.sources.tables import SENSOR_TABLES, SensorTables

#: After local midnight of a date, all rows its facts read lie in the past (the longest reach is the following day's cycles, 44 h).
FINAL = timedelta(hours=48)
MACHINES = VAPEX_VINC + VAPEX_GRINDING


@dataclass(frozen=True)
class Fact:
    name: str
    tables: tuple[str, ...]                                       # sensor tables it is computed from
    make: Callable[[SensorTables, Scope, Config], DataFrame]      # for the dates of the scope
    ahead: int = 0
    key: str = "report_date"                                      # the date of the scope that a row belongs to


def sieve_shifts(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> DataFrame:
    """The sweep's records summed by shift of either grid (Q11's shifts, and the following day's 00-08 of Q19)."""
    one = [F.struct(F.lit(g).alias("grid"), F.col(g).alias("cell"), *[F.col(f"{g}_{c}").alias(c) for c in CLASSES]) for g in GRIDS]
    sums = calibration.sieve_time(t, scope, cfg).select(F.inline(F.array(*one))).groupBy("grid", "cell").agg(
        *[F.sum(c).alias(c) for c in CLASSES])
    own = {"cal": F.lit(True), "day": cell_shift_of(F.col("cell")) == 1}
    day = F.when(F.col("grid") == "day", 1).otherwise(0)
    cells = [F.when((F.col("grid") == g) & own[g], F.col("cell")).alias(g) for g in GRIDS]
    values = [F.when(F.col("grid") == g, F.col(c)).alias(f"{g}_{c}") for g in GRIDS for c in CLASSES]
    found = sums.select(F.date_sub(cell_report_date(F.col("cell")), day).alias("report_date"), *cells, *values)
    return found.filter(F.coalesce(*GRIDS).isNotNull())


FACTS = (
    Fact("md_ext", ("md",), grinding.md_shift_facts, ahead=1),                                                # Q02, Q14
    Fact("mill_ext", ("screws",), grinding.mill_shift_facts, ahead=1),                                        # Q03, Q15, Q05
    Fact("silo_a", ("silos_a",), lambda t, s, cfg: grinding.silo_gain_facts(t.silos_a, s, cfg)),              # Q04, Q05
    Fact("silo_b_ext", ("silos_b",), lambda t, s, cfg: grinding.silo_gain_facts(t.silos_b, s, cfg), ahead=1),  # Q07, Q17
    Fact("counters_cal", ("counters",), lambda t, s, cfg: calibration.calibration_counter_gain(t, s)),        # Q09, Q11
    Fact("counters_next", ("counters",), lambda t, s, cfg: calibration.next_day_counter_gain(t, s).filter("shift = 1"),
         key="date_sub(report_date, 1)"),                                                                     # Q18, Q19
    Fact("sieves", ("remill", "silos_b"), sieve_shifts),                                                      # Q11, Q19
    Fact("cycles_day", ("machines",), lambda t, s, cfg: disinfection.day_cycles(t, s, MACHINES, cfg)),        # Q10, Q12
    Fact("cycles_cur", ("machines",), lambda t, s, cfg: disinfection.current_cycles(t, s, MACHINES, cfg)),    # Q20, Q21
    Fact("silo_kg_grinding_current", ("silos_a",), grinding.silo_kg_grinding_current),                        # Q16
    Fact("silo_total_8h_grinding", ("silos_a",), grinding.silo_total_8h_grinding),                            # Q06
    Fact("silo_total_8h_disinfection", ("silos_b",), grinding.silo_total_8h_disinfection),                    # Q08
    Fact("silo_snapshot_vinc", ("silos_c",), grinding.silo_snapshot_vinc),                                    # Q13
)


def shared_facts(t: SensorTables, scope: Scope, cfg: Config = DEFAULT_CONFIG) -> dict[str, DataFrame]:
    """The facts of the scope's reports, not stored."""
    return {f.name: f.make(t, extended(scope, f.ahead) if f.ahead else scope, cfg) for f in FACTS}


def consecutive(dates: list[date]) -> list[tuple[date, date]]:
    """First and last date of each run of consecutive dates."""
    runs: list[list[date]] = []
    for d in sorted(dates):
        if runs and d - runs[-1][-1] == timedelta(days=1):
            runs[-1].append(d)
        else:
            runs.append([d])
    return [(r[0], r[-1]) for r in runs]


def final_at(d: date, tz: str) -> datetime:
    """The instant (UTC) from which the facts of ``d`` no longer change, but for late rows."""
    loc = datetime.combine(d, time()).replace(tzinfo=ZoneInfo(tz))
    return loc.astimezone(timezone.utc).replace(tzinfo=None) + FINAL


Entries = dict[tuple[str, date], tuple[int, datetime]]      # (fact, date): the ingest that holds it, and its "now"
_ENTRY = "fact string, fact_date date, ingest int, as_of timestamp_ntz"


class FactStore:
    """Facts in a shared folder, apart for each configuration."""

    def __init__(self, spark: SparkSession, root: str, cfg: Config = DEFAULT_CONFIG):
        # (The width of a time chunk changes no result.)
        said = ";".join(f"{f.name}={getattr(cfg, f.name)!r}" for f in fields(cfg) if f.name != "window_chunk")
        self.spark, self.cfg = spark, cfg
        self.root = f"{root}/config={hashlib.sha256(said.encode()).hexdigest()[:16]}"

    def entries(self) -> Entries:
        """What is stored (a row a fact and date)."""
        ready = versions.ready(self.spark, f"{self.root}/manifest")
        if not ready:
            return {}
        rows = self.spark.read.schema(_ENTRY).parquet(f"{versions.folder(f'{self.root}/manifest', ready[-1])}/entries").collect()
        return {(r["fact"], r["fact_date"]): (r["ingest"], r["as_of"]) for r in rows}

    def _publish(self, entries: Entries) -> None:
        n = versions.begin(self.spark, f"{self.root}/manifest")
        rows = [(fact, d, ingest, as_of) for (fact, d), (ingest, as_of) in sorted(entries.items())]
        self.spark.createDataFrame(rows, _ENTRY).coalesce(1).write.parquet(f"{versions.folder(f'{self.root}/manifest', n)}/entries")
        versions.finish(self.spark, f"{self.root}/manifest", n)

    def missing(self, scope: Scope, stored: Entries) -> dict[str, list[date]]:
        """By fact, the dates of the scope's reports that have to be computed."""
        def usable(fact: str, d: date) -> bool:
            if (fact, d) not in stored:
                return False
            as_of, end = stored[fact, d][1], final_at(d, scope.tz)
            return as_of >= end and scope.now >= end

        return {f.name: [d for d in self._dates(f, scope) if not usable(f.name, d)] for f in FACTS}

    @staticmethod
    def _dates(f: Fact, scope: Scope) -> list[date]:
        return [scope.first + timedelta(days=k) for k in range((scope.last - scope.first).days + 1 + f.ahead)]

    def facts(self, t: SensorTables, scope: Scope, parallel: int = 8) -> dict[str, DataFrame]:
        """The facts of the scope's reports: computed where they are not stored, and read back from the store."""
        if scope.first is None or scope.last is None or scope.now is None:
            raise ValueError("stored facts need a literal scope")
        stored = self.entries()
        todo = [(f, a, b) for f in FACTS for a, b in consecutive(self.missing(scope, stored)[f.name])]
        if todo:
            ingests = f"{self.root}/ingests"
            n = versions.begin(self.spark, ingests)

            def write(f: Fact, a: date, b: date) -> None:
                part = Scope.for_range(self.spark, a, b, as_of=scope.now, tz=scope.tz)
                rows = part.keep(f.make(t, part, self.cfg).withColumn("fact_date", F.expr(f.key)), "fact_date")
                # A row for each date says that the fact was computed, also where it has no rows.
                marks = part.dates.select(F.col("report_date").alias("fact_date"), F.lit(False).alias("_present"))
                rows = rows.withColumn("_present", F.lit(True)).unionByName(marks, allowMissingColumns=True)
                rows.repartition("fact_date").write.mode("append").partitionBy("fact_date").parquet(
                    f"{versions.folder(ingests, n)}/{f.name}")

            by_fact: dict[str, list[tuple[Fact, date, date]]] = {}
            for x in todo:
                by_fact.setdefault(x[0].name, []).append(x)
            with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(by_fact)))) as pool:
                # (Appends to one folder follow each other.)
                for done in [pool.submit(lambda xs: [write(*x) for x in xs], xs) for xs in by_fact.values()]:
                    done.result()
            versions.finish(self.spark, ingests, n)
            for f, a, b in todo:
                stored |= {(f.name, a + timedelta(days=k)): (n, scope.now) for k in range((b - a).days + 1)}
            self._publish(stored)
        return {f.name: self._read(f, scope, stored) for f in FACTS}

    def _read(self, f: Fact, scope: Scope, stored: Entries) -> DataFrame:
        # Folders of one ingest share a base path; a run's dates come from few ingests.
        by_ingest: dict[int, list[date]] = {}
        for d in self._dates(f, scope):
            by_ingest.setdefault(stored[f.name, d][0], []).append(d)
        out = None
        for n, dates in sorted(by_ingest.items()):
            base = f"{versions.folder(f'{self.root}/ingests', n)}/{f.name}"
            part = self.spark.read.option("basePath", base).parquet(*[f"{base}/fact_date={d.isoformat()}" for d in dates])
            out = part if out is None else out.unionByName(part)
        return out.filter("_present").drop("_present", "fact_date")

    def forget(self, table: str, dates: list[date]) -> list[tuple[str, date]]:
        """Take out the facts that rows of ``table`` can have changed on ``dates``: what was taken out."""
        if table not in SENSOR_TABLES:
            raise ValueError(f"no sensor table is named {table}")
        stored, touched = self.entries(), set(dates)
        depends = {f.name for f in FACTS if table in f.tables}
        out = [(fact, d) for fact, d in stored if fact in depends and d in touched]
        if out:
            self._publish({k: v for k, v in stored.items() if k not in set(out)})
        return sorted(out)

    def drop_unused(self) -> None:
        """Remove ingests and manifests that nothing refers to (nobody may be reading them)."""
        used = {n for n, _ in self.entries().values()}
        ingests, manifest = f"{self.root}/ingests", f"{self.root}/manifest"
        versions.drop(self.spark, ingests, [n for n in versions.ready(self.spark, ingests) if n not in used])
        versions.drop(self.spark, manifest, versions.ready(self.spark, manifest)[:-1])
