"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "scorelake", shuffle_partitions: int | None = None) -> SparkSession:
    """A UTC session with adaptive execution; the cluster's own settings win where it has any."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # one JVM does all the work; on a cluster the submit settings decide
            builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A temporary folder is made only where the session names none and its master is local,
    as in tests; several machines need the setting, so its absence is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scorelake-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/scorelake/{label}-{uuid.uuid4().hex}"


def pinned(df):
    """Write the rows out and read them back, so that row positions computed above stay the same on every later read.

    Packed by column they take far less room than as a checkpoint, which is left for types that parquet lacks.
    """
    kept = fresh_dir(df.sparkSession, "pinned")
    if any(kind in df.schema.json() for kind in ('"void"', '"interval"')):
        return df.checkpoint()
    df.write.option("compression", "zstd").parquet(kept)
    return df.sparkSession.read.schema(df.schema).parquet(kept)


def spread(df):
    """Deal the rows over all cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
