"""SparkSession settings used by tests and the benchmark.

On a cluster, pass the cluster's own session: nothing here overrides a
setting that is already present (``spark.checkpoint.dir`` in particular is
read from the session and only defaulted when unset, as in local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Only calendar-sized dimensions are ever broadcast explicitly; keep the
    # automatic threshold at its default so fact tables are never broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "shiftmetrics") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    b = b.config("spark.driver.memory", os.environ.get("SHIFTMETRICS_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a session of one machine (``local[...]``, as in tests)
    gets a scratch folder; on a cluster that is an error, as other machines
    could not read it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except PySparkException:  # not readable as a runtime setting
            d = None
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="shiftmetrics-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
