"""Catalog queries against their DuckDB oracles (a representative subset by default;
TALLYLINE_FULL_ORACLE=1 runs every query)."""

import os

import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from oracle_check import compare

SUBSET = ["score_task1", "score_task2", "median_levels_task1", "staffing_pattern_predict", "parse_times",
          "clean_staffing", "describe_target", "holdout_metrics", "lookup_with_default", "ols_fit_predict"]
NAMES = list(ent.queries()) if os.environ.get("TALLYLINE_FULL_ORACLE") == "1" else SUBSET


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert "error" not in rec, rec
    if rec["has_oracle"]:
        assert rec["rows_match"] and rec["schema_match"] and rec["value_match"], rec


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["row_id", "true_processing_time_minutes"]
    assert df.count() > 0
