"""Counts that a write delivers itself: no job before, after or beside it."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scorelake.fixed_values import VALID

ACTIONS = ("INSERT", "UPDATE", "DELETE")


class WriteCounts:
    """What was written to each table since the last ``reset``.

    Every table has ``rows``; a change log also has its rows by action (``insert``, ``update``,
    ``delete``), and a table with a quality status its ``valid`` rows, and the largest
    ``query_refresh_lag_minutes`` where it has that column.
    """

    def __init__(self):
        self.tables: dict[str, Counter] = {}

    def reset(self) -> None:
        self.tables.clear()

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The rows to be written, counted on their way to the files."""
        counts = [F.count(F.lit(1)).alias("rows")]
        if "_action" in df.columns:
            counts += [F.count_if(F.col("_action") == a).alias(a.lower()) for a in ACTIONS]
        if "data_quality_status" in df.columns:
            counts.append(F.count_if(F.col("data_quality_status") == VALID).alias("valid"))
        if "query_refresh_lag_minutes" in df.columns:
            counts.append(F.max("query_refresh_lag_minutes").alias("lag_minutes"))
        seen = Observation()
        return df.observe(seen, *counts), seen

    def add(self, name: str, seen: Observation) -> None:
        """Take over the counts of a write that has ended."""
        found = {k: v for k, v in seen.get.items() if v is not None}
        known = self.tables.setdefault(name, Counter())
        lag = max((c["lag_minutes"] for c in (known, found) if "lag_minutes" in c), default=None)
        known.update(found)
        if lag is not None:
            known["lag_minutes"] = lag

    def total(self, names: list[str], key: str = "rows") -> int:
        return sum(self.tables[name][key] for name in names if name in self.tables)

    def largest(self, names: list[str], key: str) -> int | None:
        return max((self.tables[name][key] for name in names if key in self.tables.get(name, ())), default=None)
