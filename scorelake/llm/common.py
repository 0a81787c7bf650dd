"""Helpers shared by the training-data operators: tables, the shared folder, stored steps."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder serves a ``local`` master only;
    several machines need the setting, so its absence is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="scorelake-")
    return _LOCAL[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    The lineage ends here: what is lost with an executor later is read again from the
    files, and values such as generated row ids cannot change between two uses.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame) -> DataFrame:
    """The same table; whole texts go to Python a thousand rows at a time, where the session still has Spark's ten thousand."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not use yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def release() -> None:
    """Give the memory that a finished task no longer needs back to the machine; Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own account
        pass
