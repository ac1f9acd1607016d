"""Session helpers.

The library never creates a machine-local scratch area on a cluster: lineage is
cut with ``DataFrame.checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "txscore") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a session on a local master (tests, a laptop), where driver and tasks are one
    process, gets a folder of its own if the setting is absent; on a cluster that
    is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        scratch = sc._jvm.System.getProperty("java.io.tmpdir")
        configured = f"file://{scratch.rstrip('/')}/txscore-{sc.applicationId}"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df):
    """Write ``df`` once as a parquet table under the shared checkpoint folder and
    read it back: later actions reuse it with column pruning and filter pushdown,
    the lineage is cut, and a lost executor costs no recompute of the upstream
    plan. ``clear_materialized`` deletes the tables of a session."""
    import uuid
    spark = df.sparkSession
    path = f"{_materialized(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _materialized(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/txscore/materialized/{spark.sparkContext.applicationId}"


def clear_materialized(spark: SparkSession) -> None:
    """Delete the tables that ``materialize`` has written in this session. Results that
    still read them must have been consumed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_materialized(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
