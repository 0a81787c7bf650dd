"""Registered queries: a Spark callable per name, and DuckDB SQL to check it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``covers`` lists survey ids."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


class Tables:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def rounded(expression: str, digits: int = 2) -> str:
    """DuckDB SQL that rounds halves away from zero on decimal digits, as Spark does."""
    return f"CAST(ROUND(CAST(({expression}) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def titled(expression: str, delimiters: str = "!?@\"^#$&~_,.:;+-*%/|(){}<>") -> str:
    """DuckDB SQL for title case: a letter is upper-cased at the start and after white space or a delimiter."""
    quoted = delimiters.replace("'", "''")
    stops = f"(' ' || chr(9) || chr(10) || chr(13) || '{quoted}')"
    e = f"({expression})"
    return (
        f"CASE WHEN {e} IS NULL THEN NULL ELSE array_to_string(list_transform(range(1, length{e} + 1), "
        f"lambda i: CASE WHEN i = 1 OR contains({stops}, substr{e[:-1]}, i - 1, 1)) "
        f"THEN upper(substr{e[:-1]}, i, 1)) ELSE lower(substr{e[:-1]}, i, 1)) END), '') END"
    )


def cleaned(expression: str, default: str, collapse: bool = True, test_raw: bool = False) -> str:
    """DuckDB SQL for the cleaning rules."""
    body = f"regexp_replace({expression}, '\\s+', ' ', 'g')" if collapse else expression
    tested = expression if test_raw else body
    return f"CASE WHEN trim(coalesce({tested}, '')) = '' THEN '{default}' ELSE {titled(f'trim({body})')} END"
