"""Plan shape of every registered query: no nested-loop or cartesian joins,
no Python row-at-a-time UDFs, and order-dependent scans never window raw rows
by the bare key (a hot key would be one task)."""

import re

import pytest

from streamops.catalog import QUERIES
from tests.conftest import SF001

SCANNED = ["rolling_sum", "rolling_max_by", "state_jump_alert", "state_running_avg", "state_ttl",
           "state_value_counts", "win_count_sliding", "wordcount_running", "join_broadcast_threshold",
           "rolling_sum_null_key", "win_count_tumbling"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"sink_file_roundtrip"}))
def test_no_pair_enumerating_or_row_udf_operators(spark, name):
    p = plan_of(QUERIES[name](spark, SF001))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("name", SCANNED)
def test_row_windows_include_the_chunk(spark, name):
    p = plan_of(QUERIES[name](spark, SF001))
    # raw-row windows are partitioned by (chunk, key); the carry windows run
    # over the chunk table and are ordered by the chunk
    wins = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", p)
    assert wins, name
    for part, order in wins:
        assert "_chunk" in part or order.startswith("_chunk") or "_chunk" in order.split(",")[0], \
            f"{name}: window partitioned by [{part}] ordered by [{order}]"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"sink_file_roundtrip"}))
def test_no_python_in_any_registered_plan(spark, name):
    assert not re.search("MapInPandas|MapInArrow|FlatMapGroups|ArrowEvalPython", plan_of(QUERIES[name](spark, SF001)))


def test_running_word_count_reads_documents_once(spark):
    p = plan_of(QUERIES["wordcount_running"](spark, SF001))
    assert len(re.findall(r"documents\.parquet", p)) <= 2      # the plan and its initial copy


ONE_READ = ["rolling_sum", "rolling_max", "rolling_max_by", "rolling_min", "rolling_min_by", "rolling_reduce", "state_jump_alert",
            "state_top3", "state_value_counts", "state_running_sum", "state_running_avg", "state_ttl", "state_bucket_count",
            "watermark_trace", "watermark_monotonic", "late_flag", "late_side_output", "win_allowed_lateness", "win_count_sliding",
            "win_count_tumbling", "wordcount_running", "win_global_trigger", "rolling_sum_null_key", "state_top3_null_key"]


@pytest.mark.parametrize("name", ONE_READ)
def test_scans_read_their_input_once(spark, name):
    """Rows and chunk totals come from one exchange (without AQE the reuse shows in the plan)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan_of(QUERIES[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall("FileScan parquet", p)) == 1 and "ReusedExchange" in p


def test_order_sketch_is_kept_for_a_table(spark):
    from streamops.plans import scan
    from streamops.sources.tables import sensor
    scan._SKETCHES.clear()
    for _ in range(3):
        scan.density_chunk(sensor(spark, SF001), "arrival")
    assert len(scan._SKETCHES) == 1
    scan.density_chunk(sensor(spark, "/root/testdata/sf0.01"), "arrival")
    assert len(scan._SKETCHES) == 2
