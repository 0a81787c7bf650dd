"""Dimension lookups and declared relationships.

No join here carries a broadcast hint: Spark broadcasts a dimension when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution measures it at run time) and
otherwise sort-merges, splitting skewed partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dimension: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "inner") -> DataFrame:
    """Join ``fact`` to one role of a dimension.

    ``on`` maps fact columns to dimension columns, ``take`` maps dimension columns to their
    name in the result; calling it again with other columns gives the dimension another role.
    """
    renamed = dimension.select(
        *(F.col(d).alias(f"_on_{d}") for d in on.values()), *(F.col(d).alias(name) for d, name in take.items())
    )
    condition = None
    for f, d in on.items():
        term = F.col(f) == F.col(f"_on_{d}")
        condition = term if condition is None else condition & term
    return fact.join(renamed, condition, how).drop(*(f"_on_{d}" for d in on.values()))


@dataclass(frozen=True)
class Relationship:
    """``from_table.from_column`` references ``to_table.to_column``; dates may match on the day only."""

    from_table: str
    from_column: str
    to_table: str
    to_column: str
    date_part_only: bool = False


STAR_RELATIONSHIPS = [
    Relationship("delivery_fact", "match_id", "match_fact", "match_id"),
    Relationship("delivery_fact", "team_id", "team_dim", "team_id"),
    Relationship("player_dim", "team_id", "team_dim", "team_id"),
    Relationship("match_fact", "date_id", "date_dim", "date_id"),
    Relationship("match_fact", "match_type_id", "match_type_dim", "match_type_id"),
    Relationship("match_fact", "venue_id", "venue_dim", "venue_id"),
    Relationship("date_dim", "full_dt", "date_calendar", "date", date_part_only=True),
    Relationship("venue_dim", "established_dt", "venue_calendar", "date", date_part_only=True),
]


def follow(tables: dict[str, DataFrame], start: str, *route: str, relationships=None) -> DataFrame:
    """Left-join ``start`` along declared relationships to each table of ``route``.

    Every column is prefixed with its table's name, so each may be asked for later.
    """
    known = relationships or STAR_RELATIONSHIPS
    joined, reached = _prefixed(tables[start], start), [start]
    for name in route:
        link = next(r for r in known if r.to_table == name and r.from_table in reached)
        left = F.col(f"{link.from_table}__{link.from_column}")
        right = F.col(f"{name}__{link.to_column}")
        if link.date_part_only:
            left, right = left.cast("date"), right.cast("date")
        joined = joined.join(_prefixed(tables[name], name), left == right, "left")
        reached.append(name)
    return joined


def path_between(start: str, goal: str, relationships: list[Relationship] | None = None) -> list[tuple[Relationship, bool]]:
    """The links from ``start`` to ``goal``, each with whether it is followed from its referencing side.

    A filter passes from the referenced table to the referencing one and back; the shortest way
    counts. Two ways of the same length would filter differently, so they are an error.
    """
    known = relationships or STAR_RELATIONSHIPS
    ways: list[tuple[str, list[tuple[Relationship, bool]]]] = [(start, [])]
    seen = {start}
    while ways:
        arrived = [way for table, way in ways if table == goal]
        if len(arrived) > 1:
            raise ValueError(f"{start} and {goal} are joined by several ways of {len(arrived[0])} links")
        if arrived:
            return arrived[0]
        further = []
        for table, way in ways:
            further += [(r.to_table, [*way, (r, True)]) for r in known if r.from_table == table and r.to_table not in seen]
            further += [(r.from_table, [*way, (r, False)]) for r in known if r.to_table == table and r.from_table not in seen]
        seen |= {table for table, _ in further}
        ways = further
    raise ValueError(f"{start} and {goal} are not joined")


def cross_filtered(tables: dict[str, DataFrame], slicers: dict[str, Column], target: str, relationships: list[Relationship] | None = None) -> DataFrame:
    """The rows of ``target`` that the slicers leave together.

    Each slicer passes from its own table along the links as semi-joins of key columns, and
    leaves the tables on its way filtered for the next.
    """
    left = dict(tables)
    ways = {table: path_between(table, target, relationships) for table in slicers}
    for table, condition in slicers.items():
        left[table] = left[table].filter(condition)
    for table in [*ways, *ways] if len(ways) > 1 else ways:  # twice: the first round filters the tables that the ways share
        kept = left[table]
        for link, forward in ways[table]:
            near, far, name = (link.from_column, link.to_column, link.to_table) if forward else (link.to_column, link.from_column, link.from_table)
            here, there = F.col("_here"), F.col(far)
            if link.date_part_only:
                here, there = here.cast("date"), there.cast("date")
            kept = left[name] = left[name].join(kept.select(F.col(near).alias("_here")).distinct(), there == here, "left_semi")
    return left[target]


def _prefixed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{table}__{c}") for c in df.columns))
