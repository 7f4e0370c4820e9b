"""The hourly file sink splits a hot hour, and the vectorised processors equal
a row-by-row reading of their rules."""

import random
from collections import Counter

from pyspark.sql import functions as F

from streamops.sources.tables import sensor
from streamops.streaming import processors as P
from streamops.streaming import sinks
from tests.conftest import SF001
from tests.test_streaming import run_to_memory

ROWS = "id string, arrival bigint, ts_ms bigint, vc int"


def test_a_hot_hour_is_written_by_many_tasks(spark, tmp_path):
    """Half of all rows in one hour, most of them the same line."""
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("line "), F.col("id"))).otherwise("same").alias("value"),
        F.when(F.col("id") % 2 == 0, "2024-01-01 05").otherwise(F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1), F.lit(" 07"))).alias("bucket_hour"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_text_by_hour(df, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "out" / "bucket_hour=2024-01-01 05").glob("part-*"))
    assert len(files) >= 2 and max(len(f.read_text().splitlines()) for f in files) <= 15_000
    back = sinks.read_text_by_hour(spark, str(tmp_path / "out"))
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, df.collect()))
    few = [f for h in (tmp_path / "out").glob("bucket_hour=*07") for f in h.glob("part-*")]
    assert len(few) <= 9 + 4


def rows_of_a_key(rng, n):
    t, out = 0, []
    for a in range(n):
        t += rng.choice([1, 1, 5, 40])
        out.append((rng.choice(["a", "b"]), a, t, None if rng.random() < 0.2 else rng.randrange(-5, 30)))
    return out


def streamed(spark, tmp_path, rows, proc, parts):
    src = str(tmp_path / f"in{parts}")
    step = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * step:(i + 1) * step], ROWS).coalesce(1).write.mode("append").parquet(f"{src}/p{i}")
    df = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    return sorted((tuple(r) for r in run_to_memory(P.apply(df, "id", proc)).collect()), key=str)


def test_processors_over_nulls_and_cuts(spark, tmp_path):
    rows = rows_of_a_key(random.Random(4), 120)
    top, ttl, wins = [], [], []
    state = {}
    for k, a, t, v in rows:
        s = state.setdefault(k, {"top": [], "v": None, "t": None, "all": []})
        if v is not None:
            s["top"] = sorted([*s["top"], v], reverse=True)[:3]
        top.append((k, a, v, *(s["top"] + [None] * 3)[:3]))
        if s["t"] is not None and t - s["t"] >= 30:
            s["v"] = None
        ttl.append((k, a, t, v, s["v"]))
        s["v"], s["t"] = v if v is not None and v > 10 else s["v"], t
        s["all"].append(v)
        n = len(s["all"])
        some = [x for x in s["all"][-5:] if x is not None]
        if n % 5 == 0:
            wins.append((k, "tumbling", n // 5 - 1, 5, sum(some) if some else None))
        if n % 2 == 0:
            wins.append((k, "sliding", n, min(n, 5), sum(some) if some else None))
    for parts in (1, 4):
        assert streamed(spark, tmp_path / "top", rows, P.TopK(3), parts) == sorted(top, key=str)
        assert streamed(spark, tmp_path / "ttl", rows, P.EventTimeTTL(30), parts) == sorted(ttl, key=str)
        assert streamed(spark, tmp_path / "win", rows, P.CountWindows(5, 2), parts) == sorted(wins, key=str)


def test_sink_round_trip_of_the_table(spark, tmp_path):
    s = sinks.with_hour_bucket(sensor(spark, SF001)).select(F.col("id").alias("value"), "bucket_hour")
    sinks.write_text_by_hour(s, str(tmp_path / "out"))
    assert sinks.read_text_by_hour(spark, str(tmp_path / "out")).count() == s.count()
