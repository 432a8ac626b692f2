"""Session helpers: a local builder for tests and benchmarks, and lineage cuts.

Operators never build a session; they get DataFrames. These helpers are for
the caller (tests, ``bench.py``) and for the few iterative steps that want to
cut lineage through the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    app: str = "corvid",
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on).

    ``checkpoint_dir`` is only applied when the session does not name one
    already; on a cluster the cluster's setting always wins.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not shared_checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder the cluster names, if any."""
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if conf:
        return conf
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Where none is named, a temporary one is
    set, but only if driver and executors are one process."""
    found = shared_checkpoint_dir(spark)
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvid-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: the steps of an iterative
    job read it from there, whatever executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return it.

    Used between the levels of iterative jobs so that a lost executor does not
    replay every earlier level. Without a configured folder the plan stays
    lazy (Spark then recomputes from source on failure, which is still
    correct); a machine-local folder is never invented here.
    """
    if shared_checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df
