"""Re-run the report for the dates touched by newly arrived sensor files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiftmetrics.config import DEFAULT_CONFIG, Config
from shiftmetrics.functions.timegrid import to_local
from shiftmetrics.plans.scope import within
from shiftmetrics.sources.prior import UNBOUNDED, absorb_late
from shiftmetrics.sources.tables import SensorTables

# A sample at local date d can change the reports of d - 2 to d + 1: day
# windows, cycle windows, D+1 snapshots and the following day's 00-08 column
# reach back, carry-in, the 22:00 shift and the cycle window reach ahead.
BEFORE, AFTER = 2, 1


def affected_dates(batch: DataFrame, table: str, t: SensorTables, tz: str = DEFAULT_CONFIG.tz) -> list[date]:
    """The report dates that samples of ``table`` can change (a row a day, never a row a sample).

    Tables that are looked up "as of" an instant stand for all dates up to
    the entity's next sample: there the dates run on to the next local date
    on which the entity has any.
    """
    local = to_local(F.col("ts"), tz).cast("date")
    keys = UNBOUNDED[table][0] if table in UNBOUNDED else []
    days = batch.select(*keys, local.alias("d")).distinct()
    until = F.col("d")
    if table in UNBOUNDED:
        # No sample before the batch's first one can end an as-of range of the batch.
        earliest = batch.agg(F.min("ts")).first()[0]
        all_days = within(getattr(t, table), lo=earliest)
        newest = all_days.agg(F.max(local)).scalar()
        # A lookup that passes rows by (such as counters without a total) runs on to the next row it takes.
        for f in UNBOUNDED[table][1]:
            if f is not None:
                all_days = all_days.filter(F.expr(f))
        series = all_days.select(*keys, local.alias("d")).unionByName(days).distinct()
        series = series.withColumn("n", F.lead("d").over(Window.partitionBy(*keys).orderBy("d")))
        named = series.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("d").alias("_d"), "n")
        on = F.col("d") == F.col("_d")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        days = days.join(named, on, "left")
        until = F.greatest(F.col("d"), F.coalesce(F.col("n"), newest))
    spread = days.select(F.explode(F.sequence(F.date_sub("d", BEFORE), F.date_add(until, AFTER))).alias("d")).distinct()
    return sorted(r["d"] for r in spread.filter(F.col("d").isNotNull()).collect())


def refresh_on_arrival(spark: SparkSession, trigger_dir: str, trigger_schema: str,
                       tables: Callable[[], SensorTables], out_path: str, checkpoint: str,
                       cfg: Config = DEFAULT_CONFIG, available_now: bool = True,
                       table: str = "md", state_dir: str | None = None, as_of=None,
                       facts_dir: str | None = None) -> StreamingQuery:
    """Watch ``trigger_dir`` (Parquet files of the sensor table ``table``); for
    each micro-batch, write the reports of the affected dates.

    ``checkpoint`` must be a shared, durable folder (the stream's progress
    lives there, so a restarted driver resumes where it stopped).  With
    ``state_dir`` runs read the stored prior, into which late samples of the
    batch are taken up first; with ``facts_dir`` only the facts that the batch
    can have changed are computed again.
    """
    from shiftmetrics.plans.facts import FactStore, consecutive
    from shiftmetrics.plans.run import backfill

    def run(batch: DataFrame, epoch_id: int) -> None:
        t = tables()
        if state_dir is not None:
            absorb_late(spark, state_dir, table, batch)
        dates = affected_dates(batch, table, t, cfg.tz)
        if facts_dir is not None:
            FactStore(spark, facts_dir, cfg).forget(table, dates)
        for first, last in consecutive(dates):
            backfill(spark, t, first, last, out_path, as_of=as_of, cfg=cfg, state_dir=state_dir, facts_dir=facts_dir)

    stream = spark.readStream.schema(trigger_schema).parquet(trigger_dir)
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
