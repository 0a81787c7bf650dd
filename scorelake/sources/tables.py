"""Reading and writing the tables of a layer as parquet below one root folder."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from scorelake.sources.layout import bloom_options, curve_layout
from scorelake.sources.observed import WriteCounts


class Lake:
    """Parquet tables below ``root``: ``read``, ``append``, ``replace`` and partition-wise rewrite."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.counts = WriteCounts()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name)).schema
            return True
        except Exception as error:  # an absent or empty folder
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return False
            raise

    def read(self, name: str, schema=None) -> DataFrame:
        """The table, or an empty one of ``schema`` when it was never written."""
        if schema is not None and not self.exists(name):
            return typed_empty(self.spark, schema)
        return self.spark.read.parquet(self.path(name))

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        self._write(name, df, "append", partition_by)

    def replace(self, name: str, df: DataFrame, cluster_by: list[str] | None = None, partition_by: list[str] | None = None) -> None:
        """Full refresh from other tables, laid out by ``cluster_by``."""
        self._write(name, clustered(df, cluster_by) if cluster_by else df, "overwrite", partition_by)

    def replace_curved(self, name: str, df: DataFrame, columns: list[str], files: int, lookups: list[str] | None = None) -> None:
        """Full refresh laid out so that a filter on any of ``columns`` prunes files, and one value of a ``lookups`` column row groups.

        ``df`` is read three times (count, sample, write), so it should be a stored table.
        """
        options = bloom_options(lookups, df.count() // files) if lookups else {}
        self._write(name, curve_layout(df, columns, files), "overwrite", None, options)

    def rewrite_partitions(self, name: str, df: DataFrame, partition: str) -> None:
        """Overwrite only the partitions present in ``df``, which may be read from the same table."""
        self._write(name, df, "overwrite", [partition], {"partitionOverwriteMode": "dynamic"})

    def _write(self, name: str, df: DataFrame, mode: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
        """Write and count in one job; ``counts`` tells what was written."""
        rows, seen = self.counts.observed(df)
        with whole_variants(df) as packed:
            rows.write.mode(mode).options(**packed | (options or {})).partitionBy(*partition_by or []).parquet(self.path(name))
        self.counts.add(name, seen)

    def partition_files(self, name: str, partition: str) -> dict[str, str]:
        """Per partition folder the names of its files, as one text; a rewrite always changes it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs, found = root.getFileSystem(conf), {}
        for folder in fs.listStatus(root):
            label, _, value = folder.getPath().getName().partition("=")
            if label == partition:
                names = sorted(f.getPath().getName() for f in fs.listStatus(folder.getPath()))
                found[value] = hashlib.sha256("\n".join(names).encode()).hexdigest()
        return found

    def drop_partitions(self, name: str, partition: str, values: list) -> None:
        """Remove whole partitions; a rewrite leaves those alone that have no row any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for value in values:
            folder = jvm.org.apache.hadoop.fs.Path(self.path(name), f"{partition}={value}")
            folder.getFileSystem(conf).delete(folder, True)


_SHREDDING = "spark.sql.variant.writeShredding.enabled"


@contextmanager
def whole_variants(df: DataFrame):
    """Writes inside keep each variant in one piece; gives the options to pack them with. Where ``df`` has none, nothing is set.

    Shredding parts a document into very many columns, which took more than half the time of a
    load, while later layers read whole documents.
    """
    conf, before = df.sparkSession.conf, None
    variants = any(isinstance(f.dataType, VariantType) for f in df.schema)
    if variants:
        before = conf.get(_SHREDDING)
        conf.set(_SHREDDING, "false")
    try:
        yield {"compression": "zstd"} if variants else {}
    finally:
        if variants:
            conf.set(_SHREDDING, before)


def typed_empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_like(df: DataFrame) -> DataFrame:
    """Same columns, no rows; the filter folds away, so nothing is scanned."""
    return df.filter(F.lit(False))


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Range-partition and sort by ``keys`` so that row-group statistics prune well."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def month_slice(ts: Column, year: int, month: int) -> Column:
    """One calendar month as a half-open range, which parquet statistics can prune."""
    start = f"{year:04d}-{month:02d}-01"
    following = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(following).cast("timestamp_ntz"))


def split_archive(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to archive and rows that stay; rows where the predicate is NULL stay."""
    return df.filter(predicate), delete_where(df, predicate)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where the predicate holds, leave other rows as they are."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in changes.items()})


def date_list(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date"))
