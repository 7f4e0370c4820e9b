"""More streaming forms: window join, chained top-N, sessions, timers,
processing-time windows, Kafka decoding, custom and console sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from streamops.operators import joins, topn, windows
from streamops.sources.tables import sensor
from streamops.sources.text import read_lines
from streamops.streaming import processors as P
from streamops.streaming import sinks
from streamops.streaming import sources as SS
from streamops.streaming import windows as SW
from streamops.streaming.sources import events_stream, with_event_time
from tests.conftest import SF001
from tests.stream_util import split_events
from tests.test_streaming import as_set, run_to_memory

HOUR = 3_600_000


def test_window_join_stream_matches_batch(spark):
    src, _ = split_events(SF001, 3)
    s = with_event_time(events_stream(spark, src))
    got = run_to_memory(SW.window_join_stream(s.where("event_type = 'click'"), s.where("event_type = 'purchase'"),
                                              10 * HOUR, delay_ms=24 * HOUR))
    b = sensor(spark, SF001)
    want = joins.window_join(b.where("event_type = 'click'"), b.where("event_type = 'purchase'"), 10 * HOUR)
    assert as_set(got, ["id", "w_start", "l_arrival", "r_arrival"]) == as_set(want, ["id", "w_start", "l_arrival", "r_arrival"])


def test_topn_chained_stream_equals_batch(spark):
    src, _ = split_events(SF001, 3, closing=True)
    got = run_to_memory(SW.topn_chained(with_event_time(events_stream(spark, src)), 2, 10 * HOUR, 5 * HOUR, shards=7))
    cols = ["w_start", "w_end", "rank", "vc", "cnt"]
    got = got.where(F.col("w_start") < 1_720_000_000_000)     # without the closing rows' own windows
    assert as_set(got, cols) == as_set(topn.topn_all_window(sensor(spark, SF001), 2, 10 * HOUR, 5 * HOUR), cols)


def test_keyed_topn_equals_all_window_topn(spark):
    s = sensor(spark, "/root/testdata/sf0.01")
    a = as_set(topn.topn_all_window(s, 3, 10 * HOUR, 5 * HOUR), ["w_start", "rank", "vc", "cnt"])
    b = as_set(topn.topn_keyed(s, 3, 10 * HOUR, 5 * HOUR), ["w_start", "rank", "vc", "cnt"])
    assert a == b


def test_session_stream_equals_batch(spark):
    src, _ = split_events(SF001, 3, closing=True)
    got = run_to_memory(SW.session_counts(with_event_time(events_stream(spark, src)), 4 * HOUR))
    cols = ["id", "s_start", "s_end", "cnt", "sum_vc"]
    assert as_set(got.where("id <> '-1'"), cols) == as_set(windows.session_agg(sensor(spark, SF001), 4 * HOUR), cols)


def test_full_window_process_stream_equals_batch(spark):
    src, _ = split_events(SF001, 3, closing=True)
    got = run_to_memory(SW.window_process_stream(with_event_time(events_stream(spark, src)), HOUR))
    cols = ["id", "w_start", "w_end", "cnt", "arrival", "ts_ms", "vc"]
    assert as_set(got.where("id <> '-1'"), cols) == as_set(windows.window_process(sensor(spark, SF001), HOUR), cols)


def test_connect_with_expiry_stream_equals_batch(spark):
    src, _ = split_events(SF001, 3)
    s, b = with_event_time(events_stream(spark, src)), sensor(spark, SF001)
    left = F.col("event_type").isin("click", "view")
    got = run_to_memory(SW.connect_join_stream(s.where(left), s.where(~left), 6 * HOUR, delay_ms=24 * HOUR))
    want = joins.connect_join_ttl(b.where(left), b.where(~left), 6 * HOUR)
    cols = ["id", "l_arrival", "r_arrival"]
    assert as_set(got, cols) == as_set(want, cols)
    pairs = joins.connect_join(b.where(left).select("id", "arrival", "ts_ms"), b.where(~left), lcols=("arrival", "ts_ms"),
                               rcols=("arrival", "ts_ms")).where(F.abs(F.col("l_ts_ms") - F.col("r_ts_ms")) < 6 * HOUR)
    assert as_set(want, cols) == as_set(pairs, cols) and want.count() > 0


def test_native_session_window_equals_scan_sessions(spark):
    s = sensor(spark, SF001).withColumn("event_time", F.timestamp_millis("ts_ms"))
    native = s.groupBy("id", F.session_window("event_time", f"{4 * HOUR} milliseconds").alias("s")).agg(
        *windows.count_sum()).select(
        "id", F.unix_millis("s.start").alias("s_start"), F.unix_millis("s.end").alias("s_end"), "cnt", "sum_vc")
    cols = ["id", "s_start", "s_end", "cnt", "sum_vc"]
    assert as_set(native, cols) == as_set(windows.session_agg(s, 4 * HOUR), cols)


def test_event_timer_fires_once_per_key(spark):
    src, _ = split_events(SF001, 4)
    timer = 1_704_153_600_000  # 2024-01-02 00:00 UTC, inside the data
    stream = with_event_time(events_stream(spark, src)).withWatermark("event_time", "30 minutes")
    got = run_to_memory(P.apply(stream, "id", P.EventTimer(timer), time_mode="EventTime"))
    fired = got.collect()
    assert fired and all(r["timer_ms"] == timer and r["watermark_ms"] >= timer for r in fired)
    assert len({r["id"] for r in fired}) == len(fired)


def test_processing_time_windows_count_every_row(spark):
    src, _ = split_events(SF001, 2)
    for kind, size, slide, times in (("tumbling", 60_000, None, 1), ("sliding", 60_000, 20_000, 3), ("session", 60_000, None, 1)):
        got = run_to_memory(SW.processing_time_counts(events_stream(spark, src), kind, size, slide), mode="complete")
        assert got.agg(F.sum("cnt")).first()[0] == 1000 * times


def test_kafka_shaping_and_text_source(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(b"s1,1,1"),), (bytearray(b"s2,2,2"),)], "value binary")
    assert [r["value"] for r in SS.decode_kafka_value(raw).collect()] == ["s1,1,1", "s2,2,2"]
    o = SS.kafka_options("b:9092", "t", group_id="g", starting="earliest")
    assert o["subscribe"] == "t" and o["startingOffsets"] == "earliest" and o["kafka.group.id"] == "g"
    p = tmp_path / "words.txt"
    p.write_text("hello spark\nhello world\nhello java\n")
    assert [r["value"] for r in read_lines(spark, str(p)).collect()] == ["hello spark", "hello world", "hello java"]
    st = run_to_memory(SS.text_stream(spark, str(tmp_path), max_files_per_trigger=1))
    assert st.count() == 3


class _FileWriter:
    def __init__(self, folder, pid, epoch):
        self.f = open(os.path.join(folder, f"{pid}-{epoch}.txt"), "w")

    def write(self, row):
        self.f.write(f"{row['id']}\n")

    def close(self):
        self.f.close()


def test_custom_foreach_sink_and_console(spark):
    src, _ = split_events(SF001, 2)
    out = tempfile.mkdtemp(prefix="streamops-foreach-")
    sink = sinks.ForeachRowSink(lambda pid, epoch: _FileWriter(out, pid, epoch))
    q = (events_stream(spark, src).writeStream.foreach(sink)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="streamops-ck-")).start())
    q.processAllAvailable()
    q.stop()
    n = sum(len(open(os.path.join(out, f)).read().splitlines()) for f in os.listdir(out))
    assert n == 1000
    q = sinks.console(events_stream(spark, src).select("id"), "sensors", tempfile.mkdtemp(prefix="streamops-ck-"))
    q.processAllAvailable()
    q.stop()
    q = sinks.console_err(events_stream(spark, src).select("id"), "sensors_err", tempfile.mkdtemp(prefix="streamops-ck-"))
    q.processAllAvailable()
    assert q.exception() is None
    q.stop()


def test_threshold_join_stream_matches_batch(spark, tmp_path):
    from streamops.operators.joins import asof_threshold
    from streamops.streaming.asof import threshold_batches
    src, _ = split_events(SF001, 4)
    b = sensor(spark, SF001)
    config = b.where("event_type = 'signup'").withColumnRenamed("vc", "threshold")
    out = str(tmp_path / "alerts")
    data = events_stream(spark, src).where("event_type <> 'signup'")
    q = (data.writeStream.foreachBatch(threshold_batches(
            config, lambda df, bid: df.write.mode("append").parquet(out), str(tmp_path / "carry")))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    want = asof_threshold(b.where("event_type <> 'signup'"), config)
    cols = ["arrival", "id", "vc", "threshold"]
    assert as_set(spark.read.parquet(out), cols) == as_set(want, cols)


def test_idempotent_sink_replay_adds_nothing(spark, tmp_path):
    from streamops.streaming.sinks import idempotent_parquet_sink
    w = idempotent_parquet_sink(str(tmp_path / "out"))
    b = sensor(spark, SF001)
    w(b, 0)
    w(b, 0)  # replay of batch 0
    w(b.limit(10), 1)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("batch_id = 0").count() == b.count() and got.where("batch_id = 1").count() == 10


def test_generator_stream_is_capped_and_formatted(spark):
    import time as _t
    from streamops.sources.generator import generate_stream
    name = "gen_" + str(int(_t.time()))
    q = (generate_stream(spark, 20, rows_per_second=40, parts=3).writeStream.format("memory")
         .queryName(name).option("checkpointLocation", tempfile.mkdtemp(prefix="streamops-ck-")).start())
    deadline = _t.time() + 30
    while _t.time() < deadline and spark.table(name).count() < 20:
        _t.sleep(0.5)
    q.stop()
    vals = sorted(r["i"] for r in spark.table(name).collect())
    assert vals == list(range(20))
    assert {r["value"] for r in spark.table(name).collect()} == {f"Number:{i}" for i in range(20)}


def _poll_to_memory(df, done, seconds=60, mode="append"):
    """Processing-time queries keep running no-data batches, so wait for the
    expected output instead of ``processAllAvailable`` and then stop."""
    import time as _t
    import uuid as _u
    name = "q_" + _u.uuid4().hex[:8]
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="streamops-ck-")).start())
    deadline = _t.time() + seconds
    try:
        while _t.time() < deadline and not done(df.sparkSession.table(name)):
            _t.sleep(0.5)
    finally:
        q.stop()
    return df.sparkSession.table(name)


def test_processing_time_ttl_and_timer_run(spark):
    src, _ = split_events(SF001, 2)
    got = _poll_to_memory(P.apply(events_stream(spark, src), "id", P.ProcessingTimeTTL(3_600_000),
                                  time_mode="ProcessingTime"), lambda t: t.count() >= 1000)
    assert got.count() == 1000
    # a one-hour TTL does not expire during this run: some rows see a stored value
    assert got.where("state IS NOT NULL").count() > 0
    fired = _poll_to_memory(P.apply(events_stream(spark, src), "id", P.ProcessingTimer(0),
                                    time_mode="ProcessingTime"), lambda t: t.count() > 0)
    assert fired.count() > 0


def test_streaming_word_count_reaches_batch_count(spark, tmp_path):
    from streamops.functions.tokenize import tokenize_lines
    from streamops.operators.rolling import wordcount
    from streamops.sources.tables import lines_view, read_table
    lines = lines_view(read_table(spark, SF001, "documents")).limit(400)
    vals = [r["value"] for r in lines.collect()]
    src = tmp_path / "text"
    src.mkdir()
    for i in range(4):
        (src / f"part-{i}.txt").write_text("\n".join(vals[i * 100:(i + 1) * 100]) + "\n")
    got = run_to_memory(SW.word_counts_stream(SS.text_stream(spark, str(src), max_files_per_trigger=1)), mode="update")
    final = {r["word"]: r["m"] for r in got.groupBy("word").agg(F.max("cnt").alias("m")).collect()}
    want = {r["word"]: r["cnt"] for r in wordcount(tokenize_lines(spark.createDataFrame([(v,) for v in vals], "value string"))).collect()}
    assert final == want


def test_stateless_operators_run_unchanged_on_streams(spark):
    from streamops.functions.parse import parse_sensor_lines
    from streamops.operators import transform
    from streamops.operators.windows import assign_sliding
    from streamops.sources.tables import sensor_lines
    src, _ = split_events(SF001, 3)
    st, b = events_stream(spark, src), sensor(spark, SF001)
    cases = {
        "flatmap": lambda d: transform.flatmap_by_key(d, "event_type", {"click": ["vc"], "view": ["ts_ms", "vc"]},
                                                      keep=["arrival"]),
        "route": lambda d: transform.with_route(d, "event_type", {"click": "tag1"}).select("arrival", "route"),
        "alarm": lambda d: transform.alarm_split(d, "vc", 10)[1].select("arrival"),
        "sliding": lambda d: assign_sliding(d, 5 * 3_600_000, 2 * 3_600_000).select("arrival", "w_start"),
        "parse": lambda d: parse_sensor_lines(sensor_lines(d), keep=["rec"])[0].select("rec", "id", "ts", "vc"),
    }
    for name, f in cases.items():
        got = run_to_memory(f(st))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, f(b).collect())), name


def test_kafka_records_shape(spark):
    from streamops.sources.tables import sensor_lines
    b = sensor(spark, SF001)
    rec = sinks.kafka_records(sinks.kafka_value_rows(sensor_lines(b), id_col="rec"))
    assert rec.columns == ["value", "headers"]
    r = rec.first()
    assert r["headers"][0]["key"] == "dedup_id" and bytes(r["headers"][0]["value"]).decode().isdigit()
    keyed = sinks.kafka_records(sinks.kafka_keyed_rows(sensor_lines(b), "t"))
    assert keyed.columns == ["key", "value", "topic"] and keyed.count() == b.count()
