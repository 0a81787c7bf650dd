"""Importing this module registers every query."""

from scorelake.workload import (  # noqa: F401
    dimension_queries,
    layer_queries,
    load_queries,
    mutation_queries,
    nested_queries,
    quality_queries,
    relational_queries,
    scalar_queries,
    series_queries,
    upkeep_queries,
)
