"""Path access and flattening of nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.text import drop_null_literals


def path(variant: Column | str, json_path: str, type_: str = "string", strict: bool = False) -> Column:
    """Value at ``json_path``; missing paths and indexes out of range are NULL.

    A strict read fails on values of the wrong type, otherwise they are NULL. Texts
    that stand for a missing value become NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    value = get(variant, json_path, type_)
    return drop_null_literals(value) if type_ == "string" else value


def flatten_array(df: DataFrame, array: Column, as_: str, outer: bool = False, position: str | None = None) -> DataFrame:
    """One row per element; ``outer`` keeps rows whose array is missing or empty."""
    if position:
        generate = F.posexplode_outer if outer else F.posexplode
        return df.select("*", generate(array).alias(position, as_))
    generate = F.explode_outer if outer else F.explode
    return df.select("*", generate(array).alias(as_))


def flatten_map(df: DataFrame, mapping: Column, key: str, value: str, outer: bool = False) -> DataFrame:
    """One row per entry of a map."""
    generate = F.explode_outer if outer else F.explode
    return df.select("*", generate(mapping).alias(key, value))


def flatten_variant(df: DataFrame, variant: Column, outer: bool = False, prefix: str = "") -> DataFrame:
    """One row per element of a variant array or object, with ``pos``, ``key`` and ``value``."""
    tvf = df.sparkSession.tvf
    table = (tvf.variant_explode_outer if outer else tvf.variant_explode)(variant.outer())
    if prefix:
        table = table.select(*(F.col(c).alias(f"{prefix}_{c}") for c in ("pos", "key", "value")))
    return df.lateralJoin(table)
