"""Opaque-function hooks give the same answers as the built-in forms."""

import pandas as pd
from pyspark.sql import functions as F

from streamops.operators import partition, udf, windows
from streamops.sources.tables import sensor
from tests.conftest import SF001


def test_map_batches_and_series_function(spark):
    s = sensor(spark, SF001)
    out = udf.map_batches(s.select("arrival", "vc"), lambda p: p.assign(vc=p.vc + 1), "arrival long, vc int")
    want = s.select("arrival", (F.col("vc") + 1).alias("vc"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    inc = udf.series_function(lambda v: v * 2, "int")
    assert s.select(inc("vc").alias("x")).agg(F.sum("x")).first()[0] == 2 * s.agg(F.sum("vc")).first()[0]


def test_grouped_aggregate_and_window_process(spark):
    s = sensor(spark, SF001)
    total = udf.grouped_aggregate(lambda v: int(v.sum()), "long")
    a = {r["id"]: r["t"] for r in s.groupBy("id").agg(total("vc").alias("t")).collect()}
    b = {r["id"]: r["sum_vc"] for r in windows.global_window(s).collect()}
    assert a == b

    def per_window(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": [pdf.id.iloc[0]], "w_start": [pdf.w_start.iloc[0]],
                             "cnt": [len(pdf)], "sum_vc": [int(pdf.vc.sum())]})

    got = udf.window_process_pandas(s, 3_600_000, per_window, "id string, w_start long, cnt long, sum_vc long")
    want = windows.tumbling_agg(s, 3_600_000).select("id", "w_start", "cnt", "sum_vc")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_random_partition_is_deterministic(spark):
    s = sensor(spark, SF001).select("arrival", "id")
    a = partition.with_partition_id(partition.random_partition(s, 8)).collect()
    b = partition.with_partition_id(partition.random_partition(s, 8)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len({r["pid"] for r in a}) == 8


def test_equal_rows_spread_over_partitions(spark):
    same = spark.range(1000).select(F.lit("x").alias("id"), F.lit(1).alias("vc"))
    got = partition.with_partition_id(partition.random_partition(same, 8)).groupBy("pid").count().collect()
    assert len(got) == 8 and max(r["count"] for r in got) < 250


def test_by_key_puts_each_key_in_one_partition(spark):
    s = sensor(spark, SF001)
    got = partition.with_partition_id(partition.by_key(s, "id")).groupBy("id").agg(F.count_distinct("pid").alias("n"))
    assert {r["n"] for r in got.collect()} == {1}


def test_table_function_hook(spark):
    s = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "k int, v string")
    out = udf.flat_map_rows(s, lambda v: [(w, len(w)) for w in (v or "").split()], "w string, n int", "v")
    assert sorted(map(tuple, out.select("k", "w", "n").collect())) == [(1, "a", 1), (1, "b", 1)]
