"""Spark session defaults and lineage helpers.

The settings here are the ones the jobs in this package are written for:
AQE on (runtime coalescing, skew-join splitting, broadcast conversion from
*measured* shuffle sizes), UTC session time, ANSI mode.  On a cluster the
caller's own session is used as-is; only missing settings are filled in.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes.  They are applied only where the session does
# not already define them, so a cluster configuration always wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go with the frames that were cut.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Local/test session.  On a cluster use the session you are given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Fill in missing job settings on an existing session, and let Python workers
    import this package from where the driver has it (a cluster ships it)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, when it is unset (tests, a laptop), a private scratch folder is
    created; on a cluster a folder of one machine would not be seen by the others.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) into the shared checkpoint dir."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
