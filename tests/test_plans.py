"""Physical-plan properties the operators were tuned for (AQE off to see the static plan)."""

import pytest

from conftest import SF_SMALL
from __spark_entry__ import queries


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_one_exchange_with_partial_group_limit(static):
    p = _plan(queries()["user_scores"](static, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in p and "Partial" in p      # top-N trimmed before the shuffle
    assert "BroadcastExchange" not in p and "SortMergeJoin" not in p


def test_scan_reads_only_needed_columns(static):
    p = _plan(queries()["user_counts"](static, SF_SMALL))
    assert "ReadSchema: struct<user_id:bigint>" in p


def test_validation_keeps_derived_columns_computed_once(static):
    p = _plan(queries()["valid_only"](static, SF_SMALL))
    assert "SPARK_PARTITION_ID" in p.upper()               # barrier projection present
    assert "PushedFilters: []" in p


def test_error_lane_has_no_inferred_size_filter(static):
    """A plain explode would make Catalyst infer size(errors) > 0 and push the
    whole rule tree into the scan filter; explode_outer + a null filter avoids it."""
    p = _plan(queries()["validation_errors"](static, SF_SMALL))
    assert "Generate explode_outer" in p or "Generate explode" in p
    assert "size(flatten" not in p.split("Generate")[1]      # nothing below the generator filters on it
    assert "*(" in p                                          # whole-stage codegen stages
