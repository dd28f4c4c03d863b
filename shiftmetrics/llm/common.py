"""Reading, splitting and joining helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftmetrics.session import ensure_checkpoint_dir

#: Largest id list (rows) that is broadcast; longer ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


#: Bytes of an Arrow batch that goes to a Python worker (a longer row stands alone).
BATCH_BYTES = 4_000_000

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python path of workers started from now on, for sessions
    whose environment lacks it; where the package is installed this changes nothing."""
    small_batches(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, ROOT]))


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers by bytes, so that long texts do not add up; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have: the given ones, longer where they are taken."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` into the session's shared checkpoint folder and read it back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the session's shared checkpoint folder, read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def py_fold(doc_id, parts: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a count proves that ``df`` has at most ``rows`` narrow rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def never_sent(df: DataFrame) -> DataFrame:
    """Hint a join of two shuffles.  Spark sizes a table by its files: compressed ones, or what a Python step makes of them, are
    many times as large in memory, and would be collected in the driver for a broadcast."""
    return df.hint("merge")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` labelled training rows of each class.

    Training rows are those whose crc32(doc_id) mod 3 is not 1.  The rows of a
    class are taken in the order of a hash of their id, so the same rows come
    back whatever the partitioning; of rows that repeat an id the smallest text
    counts.  The bound makes the broadcast of the ids and the collected texts small.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1)).distinct()
    picked = None
    for y in (0, 1):
        some = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    rows = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(
        F.min("text").alias("text")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "text").select("text", "y").collect()
    return [(r["text"] or "", r["y"]) for r in rows]
