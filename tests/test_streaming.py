"""Streaming forms reach the batch answers however the input is cut."""

import os
import shutil
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from streamops.operators import joins, lateness, state, windows
from streamops.sources.tables import sensor, with_jitter
from streamops.streaming import processors as P
from streamops.streaming import lateness as SL
from streamops.streaming import router, sinks
from streamops.streaming import windows as SW
from streamops.streaming.sources import events_stream, with_event_time
from tests.conftest import SF001
from tests.stream_util import split_events


def run_to_memory(df, mode="append", checkpoint=None):
    name = "q_" + uuid.uuid4().hex[:8]
    ck = checkpoint or tempfile.mkdtemp(prefix="streamops-ck-")
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", ck).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def as_set(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_jump_alert_split_invariant(spark, parts):
    src, _ = split_events(SF001, parts)
    out = run_to_memory(P.apply(events_stream(spark, src), "id", P.JumpAlert(10)))
    want = state.jump_alert(sensor(spark, SF001), threshold=10)
    cols = ["arrival", "id", "vc", "prev_vc"]
    assert as_set(out, cols) == as_set(want, cols)


def test_processors_match_batch_forms(spark):
    src, _ = split_events(SF001, 4)
    s = sensor(spark, SF001)
    stream = events_stream(spark, src)
    cases = [
        (P.TopK(3), state.running_top_k(s, 3), ["arrival", "id", "vc", "top1", "top2", "top3"]),
        (P.ValueCounts(), state.value_counts_running(s), ["arrival", "id", "vc", "cnt"]),
        (P.RunningSumAvg(), state.running_avg(s).join(state.running_sum(s).select("arrival", "sum_vc"), "arrival"),
         ["arrival", "id", "vc", "sum_vc", "avg_vc"]),
        (P.EventTimeTTL(5 * 3600 * 1000), state.ttl_state(s, 5 * 3600 * 1000), ["arrival", "id", "ts_ms", "vc", "state"]),
    ]
    for proc, want, cols in cases:
        got = run_to_memory(P.apply(stream, "id", proc))
        assert as_set(got, cols) == as_set(want, cols), type(proc).__name__


def test_count_windows_match_batch(spark):
    src, _ = split_events(SF001, 3)
    got = run_to_memory(P.apply(events_stream(spark, src), "id", P.CountWindows(5, 2)))
    s = sensor(spark, SF001)
    tumb = windows.count_window_tumbling(s, 5)
    assert as_set(got.where("kind = 'tumbling'").withColumnRenamed("pos", "win_no"), ["id", "win_no", "cnt", "sum_vc"]) == \
        as_set(tumb, ["id", "win_no", "cnt", "sum_vc"])
    sl = windows.count_window_sliding(s, 5, 2)
    assert as_set(got.where("kind = 'sliding'"), ["id", "pos", "cnt", "sum_vc"]) == as_set(sl, ["id", "pos", "cnt", "sum_vc"])


def run_to_parquet(df, path, checkpoint):
    q = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(path)
    q.processAllAvailable()
    q.stop()


def test_bucket_count_restarts_from_checkpoint(spark):
    src, paths = split_events(SF001, 4, first=2)
    ck = tempfile.mkdtemp(prefix="streamops-ck-")
    out = tempfile.mkdtemp(prefix="streamops-out-")
    stream = events_stream(spark, src).withColumn("bucket", F.pmod("arrival", F.lit(4)).cast("int"))
    run_to_parquet(P.apply(stream, "bucket", P.BucketCount()), out, ck)
    first = as_set(spark.read.parquet(out), ["bucket", "arrival", "cnt"])
    for p in paths[2:]:
        shutil.copy2(p, os.path.join(src, os.path.basename(p)))
    # a new query object on the same checkpoint: state and offsets are restored
    stream = events_stream(spark, src).withColumn("bucket", F.pmod("arrival", F.lit(4)).cast("int"))
    run_to_parquet(P.apply(stream, "bucket", P.BucketCount()), out, ck)
    both = as_set(spark.read.parquet(out), ["bucket", "arrival", "cnt"])
    want = as_set(state.bucket_running_count(sensor(spark, SF001), 4), ["bucket", "arrival", "cnt"])
    assert both == want
    assert 0 < len(first) < len(both)


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_late_classification_split_invariant(spark, parts):
    src, _ = split_events("/root/testdata/sf0.01", parts, jitter=True)
    out_dir = tempfile.mkdtemp(prefix="streamops-late-")
    carry = tempfile.mkdtemp(prefix="streamops-carry-")

    def sink(df, batch_id):
        df.select("arrival", "lateness").write.mode("append").parquet(out_dir)

    stream = with_jitter(events_stream(spark, src))
    q = (stream.writeStream.foreachBatch(SL.classify_batches(carry, 30 * 60_000, 3_600_000, 20 * 60_000, sink))
               .option("checkpointLocation", tempfile.mkdtemp(prefix="streamops-ck-")).start())
    q.processAllAvailable()
    q.stop()
    got = as_set(spark.read.parquet(out_dir), ["arrival", "lateness"])
    batch = lateness.classify_tumbling(lateness.watermark_trace(with_jitter(sensor(spark, "/root/testdata/sf0.01")),
                                                                30 * 60_000), 3_600_000, 20 * 60_000)
    assert got == as_set(batch, ["arrival", "lateness"])
    assert sum(1 for _, c in got if c == "closed") == 14


def test_interval_join_stream_matches_batch(spark):
    src, _ = split_events(SF001, 3)
    s = with_event_time(events_stream(spark, src))
    l, r = s.where("event_type = 'click'"), s.where("event_type = 'purchase'")
    got = run_to_memory(SW.interval_join_stream(l, r, -2 * 3600_000, 2 * 3600_000, delay_ms=24 * 3600_000))
    b = sensor(spark, SF001)
    want = joins.interval_join(b.where("event_type = 'click'"), b.where("event_type = 'purchase'"),
                               -2 * 3600_000, 2 * 3600_000)
    assert as_set(got, ["id", "l_arrival", "r_arrival"]) == as_set(want, ["id", "l_arrival", "r_arrival"])


def test_windowed_counts_stream_equal_batch(spark):
    src, _ = split_events(SF001, 4, closing=True)
    stream = with_event_time(events_stream(spark, src))
    cols = ["id", "w_start", "w_end", "cnt", "sum_vc"]
    s = sensor(spark, SF001)
    data = F.col("id") != "-1"
    assert as_set(run_to_memory(SW.windowed_counts(stream, 3_600_000)).where(data), cols) == as_set(
        windows.tumbling_agg(s, 3_600_000), cols)
    assert as_set(run_to_memory(SW.windowed_counts(stream, 36_000_000, 18_000_000)).where(data), cols) == as_set(
        windows.sliding_agg(s, 36_000_000, 18_000_000), cols)


def test_router_and_file_sink(spark):
    src, _ = split_events(SF001, 2)
    out = {n: tempfile.mkdtemp(prefix=f"streamops-{n}-") for n in ("main", "tag1", "tag2")}
    writers = {n: (lambda p: lambda df, b: df.select("arrival").write.mode("append").parquet(p))(p)
               for n, p in out.items()}
    q = (events_stream(spark, src).writeStream
         .foreachBatch(router.route_batches("event_type", {"click": "tag1", "purchase": "tag2"}, writers))
         .option("checkpointLocation", tempfile.mkdtemp(prefix="streamops-ck-")).start())
    q.processAllAvailable()
    q.stop()
    n = {k: spark.read.parquet(p).count() for k, p in out.items()}
    b = sensor(spark, SF001)
    assert n["tag1"] == b.where("event_type = 'click'").count()
    assert n["tag2"] == b.where("event_type = 'purchase'").count()
    assert sum(n.values()) == b.count()
    # streaming text sink by event hour
    lines = sinks.with_hour_bucket(events_stream(spark, src)).select(
        F.concat_ws(",", "id", F.col("ts_ms").cast("string"), F.col("vc").cast("string")).alias("value"), "bucket_hour")
    path = tempfile.mkdtemp(prefix="streamops-text-")
    q = sinks.stream_text_by_hour(lines, path, tempfile.mkdtemp(prefix="streamops-ck-"))
    q.processAllAvailable()
    q.stop()
    assert sinks.read_text_by_hour(spark, path).count() == b.count()


def test_allowed_lateness_updates_reach_final_firing(spark, tmp_path):
    src, _ = split_events("/root/testdata/sf0.01", 5, jitter=True)
    routed = str(tmp_path / "routed")
    q = (with_jitter(events_stream(spark, src)).writeStream
         .foreachBatch(SL.classify_batches(str(tmp_path / "carry"), 30 * 60_000, 3_600_000, 20 * 60_000,
                                           SL.routed_rows_sink(routed)))
         .option("checkpointLocation", str(tmp_path / "ck1")).start())
    q.processAllAvailable()
    q.stop()
    schema = spark.read.parquet(routed).schema
    upd = run_to_memory(SL.window_updates(spark, routed, schema, 3_600_000, 30 * 60_000, 20 * 60_000),
                        mode="update", checkpoint=str(tmp_path / "ck2"))
    got = as_set(upd.groupBy("id", "w_start").agg(F.max("cnt").alias("cnt"), F.max("sum_vc").alias("sum_vc")),
                 ["id", "w_start", "cnt", "sum_vc"])
    batch = lateness.window_firings(lateness.classify_tumbling(lateness.watermark_trace(
        with_jitter(sensor(spark, "/root/testdata/sf0.01")), 30 * 60_000), 3_600_000, 20 * 60_000))
    final = batch.groupBy("id", "w_start").agg(F.max("cnt").alias("cnt"), F.max("sum_vc").alias("sum_vc"))
    assert got == as_set(final, ["id", "w_start", "cnt", "sum_vc"])
