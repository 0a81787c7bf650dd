"""JSON documents: scan, split, project, reject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = ["stg_file_name", "stg_file_row_number", "stg_file_hashkey", "stg_modified_ts"]


def file_texts(reader, path) -> DataFrame:
    """One row per file: its whole text, name and modification time.

    ``reader`` is ``spark.read`` or ``spark.readStream``, so batch and streaming loads share the rest.
    """
    return reader.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified_ts"),
    )


def split_documents(texts: DataFrame) -> DataFrame:
    """One row per document with file lineage; an outer array is stripped.

    Text that is not JSON keeps one row with a NULL ``doc``, so the load goes on and
    :func:`rejected_documents` can list it.
    """
    body = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(
        F.concat(F.lit("["), F.col("value"), F.lit("]"))
    )
    parsed = texts.select(
        F.col("file_name").alias("stg_file_name"),
        F.sha2("value", 256).alias("stg_file_hashkey"),
        F.col("modified_ts").alias("stg_modified_ts"),
        F.try_parse_json(body).alias("_docs"),
    )
    spark = texts.sparkSession
    return parsed.lateralJoin(spark.tvf.variant_explode_outer(F.col("_docs").outer())).select(
        F.col("value").alias("doc"),
        "stg_file_name",
        (F.coalesce("pos", F.lit(0)) + 1).alias("stg_file_row_number"),
        "stg_file_hashkey",
        "stg_modified_ts",
    )


def raw_projection(documents: DataFrame) -> DataFrame:
    """``meta``, ``info`` and ``innings`` as variants, plus lineage."""
    return documents.select(
        F.try_variant_get("doc", "$.meta", "variant").alias("meta"),
        F.try_variant_get("doc", "$.info", "variant").alias("info"),
        F.try_variant_get("doc", "$.innings", "variant").alias("innings"),
        *LINEAGE,
    )


def accepted_raw(raw: DataFrame, load_ts=None) -> DataFrame:
    """Rows whose payload and lineage are complete, stamped with the load time.

    The missing columns are counted in one expression. Separate NOT NULL conditions on the
    content key would be pushed below the parse and hash every file a second time.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if load_ts is None else load_ts
    missing = F.lit(0)
    for column in ["meta", "info", "innings", *LINEAGE]:
        missing = missing + F.col(column).isNull().cast("int")
    return raw.filter(missing == 0).withColumn("load_timestamp", stamp)


def rejected_documents(raw: DataFrame) -> DataFrame:
    """Lineage and reason of every document that cannot enter the raw table."""
    reason = (
        F.when(F.col("info").isNull() & F.col("meta").isNull() & F.col("innings").isNull(), "unreadable document")
        .when(F.col("meta").isNull(), "meta missing")
        .when(F.col("info").isNull(), "info missing")
        .when(F.col("innings").isNull(), "innings missing")
    )
    return raw.select(reason.alias("rejection_reason"), *LINEAGE).filter(F.col("rejection_reason").isNotNull())


def read_documents(spark: SparkSession, path) -> DataFrame:
    return raw_projection(split_documents(file_texts(spark.read, path)))


def preview_file(spark: SparkSession, path: str) -> DataFrame:
    """Documents of one file as they would be loaded."""
    return read_documents(spark, path)


def document_from_text(spark: SparkSession, text: str, file_name: str, row_number: int = 1, modified_ts=None) -> DataFrame:
    """A raw row from JSON text, for inserting a document by hand."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if modified_ts is None else F.lit(modified_ts).cast("timestamp_ntz")
    row = spark.createDataFrame([(text, file_name, row_number)], "value string, stg_file_name string, stg_file_row_number int")
    return raw_projection(
        row.select(
            F.parse_json("value").alias("doc"),
            "stg_file_name",
            "stg_file_row_number",
            F.sha2("value", 256).alias("stg_file_hashkey"),
            stamp.alias("stg_modified_ts"),
        )
    )


def unloaded_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files, by content key, that are not in the ledger of loaded files."""
    seen = ledger.select("stg_file_hashkey").distinct()
    return files.join(seen, "stg_file_hashkey", "left_anti")
