"""Registered queries against DuckDB; SCORELAKE_ALL_QUERIES=1 checks every one."""

import os
import subprocess
import sys

import pytest

import check_queries
from __spark_entry__ import entry
from scorelake.workload.registry import ORACLES, QUERIES

SAMPLE = [
    "flatten_deliveries", "match_projection", "clean_text_rules", "calendar_parts", "boundary_differences", "star_join", "full_outer_series",
    "rank_in_group", "rolling_five", "merge_newer_wins", "stream_append", "null_gate", "team_dim", "match_fact", "player_performance",
    "match_summary", "weekly_volatility", "weekly_correlation", "task_status", "layer_retention", "layer_quality_shares",
]
NAMES = sorted(QUERIES) if os.environ.get("SCORELAKE_ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con(sf):
    return check_queries.connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf, con, name):
    result, _ = check_queries.compare(spark, con, sf, name)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_every_query_has_check_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("absent", ["scorelake.llm", "corpus_pipeline", "tokenizers", "sentencepiece"])
def test_the_entry_stands_without_optional_parts(absent):
    """A module that cannot be imported takes its own queries away and no others."""
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; from scorelake.workload.registry import QUERIES; assert set(QUERIES) <= set(e.queries()); print(sorted(set(e.queries()) - set(QUERIES)))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=False)
    assert found.returncode == 0, found.stderr
    assert "pipeline" not in found.stdout and ("op2" in found.stdout) == (absent == "corpus_pipeline")


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "team_name"
