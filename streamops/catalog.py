"""Registered queries: one per operator, each reading the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` is the Spark form;
``ORACLE[name]`` is an independent SQL form for DuckDB over the same tables.
Column names and integer widths match between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.functions.parse import parse_sensor_lines
from streamops.functions.scalar import scalar_bundle
from streamops.functions.tokenize import tokenize_lines
from streamops.operators import (joins, lateness, partition, rolling, sessions, state, timers, topn, transform, triggers,
                                 windows)
from streamops.plans.scan import density_chunk
from streamops.sources.tables import (JITTER_MOD, JITTER_MULT, JITTER_STEP_MS, candidate_lines, lines_view,
                                      read_table, sensor, sensor_lines, with_jitter)
from streamops.streaming import sinks

# --- parameters, scaled to the event data (FIXTURES.md section 3) ----------
HOUR = 3_600_000
MIN = 60_000
TUMBLE = HOUR
META_TUMBLE = 2 * HOUR
SLIDE_SIZE, SLIDE_STEP = 10 * HOUR, 5 * HOUR
UNEVEN_SIZE, UNEVEN_STEP = 5 * HOUR, 2 * HOUR
SESSION_GAP = 4 * HOUR
COUNT_SIZE, COUNT_SLIDE = 5, 2
DELAY, LATENESS = 30 * MIN, 20 * MIN
# the sliding side output: windows short enough that the synthetic delay closes some
LATE_SIZE, LATE_STEP, LATE_LATENESS = 10 * MIN, 5 * MIN, 5 * MIN
# sessions with late data: short enough that some rows bridge sessions, fire them again or are rejected
SESSION_LATE_GAP, SESSION_LATE_DELAY, SESSION_LATE_KEPT = 15 * MIN, 5 * MIN, 20 * MIN
PERIODIC_EVERY = 100
WINDOW_JOIN = 10 * HOUR
INTERVAL = 2 * HOUR
TTL = 5 * HOUR
CONNECT_TTL = 6 * HOUR
TOP_N = 2
TOP_K_STATE = 3
SNAPSHOT = 20
JUMP = 10
ALARM = 10
BUCKETS = 4
PARTS = 8
COPIES = 4
DOCS_PER_CHUNK = 4096
# M3 is an id filter by definition (keep rows whose id equals a constant).  The
# query runs over the whole events table; the pushed-down predicate only lets
# the reader skip row groups whose statistics exclude the id.
FILTER_ID = "7"
TIMER_AT = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC
FLATMAP = {"click": ["vc"], "view": ["ts_ms", "vc"]}
ROUTES = {"click": "tag1", "purchase": "tag2"}
TOPIC = "sensor"
# A timer at the next full hour of the row's time; a trigger of three rules; config values beyond an INT.
HOURLY = f"ts_ms - pmod(ts_ms, {HOUR}) + {HOUR}"
TRIGGER = triggers.Trigger(when="vc > 90", every_ms=48 * HOUR, count=6)
TRIGGER_KEEP = triggers.Trigger(when="vc % 10 = 7")
TRIGGER_TIME = triggers.Trigger(every_ms=24 * HOUR)
ENTRIES = ("click", "view", "purchase")
BIG = 10_000_000_000
LEFT_TYPES = ("click", "view")
NO_KEY_TYPE = "view"


def _sensor(spark, d):
    return sensor(spark, d)


def _jitter(spark, d):
    return with_jitter(sensor(spark, d))


def _clock(spark, d):
    return _jitter(spark, d).select("id", "ts_ms", "arr_ms", "arrival")


def _lines(spark, d):
    return lines_view(read_table(spark, d, "documents"))


def _tokens(spark, d):
    return tokenize_lines(_lines(spark, d), keep=["doc_id", "line_no"])


def _sides(spark, d):
    """Two sides that together hold every event."""
    s = _sensor(spark, d)
    left = F.col("event_type").isin(*LEFT_TYPES)
    return s.where(left), s.where(~left)


def _no_key(s):
    """The same rows with a NULL key for one event type."""
    return s.withColumn("id", F.when(F.col("event_type") != NO_KEY_TYPE, F.col("id")))


def _some_values(s):
    """The same rows with a NULL value in seven of ten, so that whole frames are NULL."""
    return s.withColumn("vc", F.when(F.col("vc") % 10 >= 7, F.col("vc")))


def _config(s):
    """Sign-ups as config rows: they put a value, sometimes NULL, under one of three entries."""
    entry = F.element_at(F.array(*map(F.lit, ENTRIES)), (F.col("arrival") % 3 + 1).cast("int"))
    return s.where("event_type = 'signup'").select(
        "arrival", entry.alias("name"), F.when(F.col("vc") % 5 != 0, F.col("vc") * BIG).alias("value"))


def _data(s):
    return s.where("event_type <> 'signup'").select("arrival", "id", "event_type", "vc")


def _firings(j):
    traced = lateness.watermark_trace(j, DELAY, keep=["arrival", "arr_ms", "ts_ms", "id", "vc"])
    cls = lateness.classify_tumbling(traced, TUMBLE, LATENESS)
    return lateness.window_firings(cls)


def _parsed(spark, d):
    return parse_sensor_lines(candidate_lines(spark, d), keep=["source", "rec", "pos"])


def _traced(spark, d, *cols):
    return lateness.watermark_trace(_jitter(spark, d), DELAY, keep=["arrival", "arr_ms", "ts_ms", *cols])


def _classified(spark, d):
    return lateness.classify_tumbling(_traced(spark, d, "id", "vc"), TUMBLE, LATENESS)


def _file_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    from streamops.session import scratch_path
    path = scratch_path(spark, "file-sink")
    s = sinks.with_hour_bucket(_sensor(spark, d))
    rows = s.select(F.concat_ws(",", "id", F.col("ts_ms").cast("string"), F.col("vc").cast("string")).alias("value"),
                    "bucket_hour")
    sinks.write_text_by_hour(rows, path)
    return sinks.read_text_by_hour(spark, path)


def _part_rows(df):
    return df.select("arrival", "id", "vc")


QUERIES = {
    # sources
    "src_text": lambda sp, d: _lines(sp, d),
    "src_generator": lambda sp, d: read_table(sp, d, "events").select(
        F.col("event_id").alias("i"), F.concat(F.lit("Number:"), F.col("event_id").cast("string")).alias("value")),
    # parse / map / filter / route
    "parse_sensor_lines": lambda sp, d: _parsed(sp, d)[0],
    "parse_sensor_rejects": lambda sp, d: _parsed(sp, d)[1],
    "map_project": lambda sp, d: transform.map_project(_sensor(sp, d), ["arrival", "id"]),
    "filter_eq": lambda sp, d: transform.filter_eq(sensor(sp, d, id_equals=FILTER_ID), "id", FILTER_ID).select(
        "arrival", "id", "ts_ms", "vc"),
    "flatmap_conditional": lambda sp, d: transform.flatmap_by_key(_sensor(sp, d), "event_type", FLATMAP, keep=["arrival"]),
    "tokenize_lines": lambda sp, d: _tokens(sp, d),
    "map_increment": lambda sp, d: transform.map_increment(_sensor(sp, d), "vc", keep=["arrival"]),
    "split_even": lambda sp, d: transform.split_even_odd(_sensor(sp, d), "vc")[0].select("arrival", "vc"),
    "split_odd": lambda sp, d: transform.split_even_odd(_sensor(sp, d), "vc")[1].select("arrival", "vc"),
    "route_main": lambda sp, d: transform.route_outputs(_sensor(sp, d), "event_type", ROUTES)["main"].select(
        "arrival", "id", "event_type"),
    "route_tagged": lambda sp, d: transform.with_route(_sensor(sp, d), "event_type", ROUTES).where(
        F.col("route") != "main").select("arrival", "id", "route"),
    "alarm_threshold": lambda sp, d: transform.alarm_split(_sensor(sp, d), "vc", ALARM)[1].select("arrival", "id", "vc"),
    "scalar_bundle": lambda sp, d: scalar_bundle(_sensor(sp, d)),
    # partitioning
    "part_random": lambda sp, d: partition.random_partition(_part_rows(_sensor(sp, d))),
    "part_round_robin": lambda sp, d: _part_rows(partition.round_robin(_sensor(sp, d))),
    "part_rescale": lambda sp, d: _part_rows(partition.rescale(_sensor(sp, d))),
    "part_broadcast": lambda sp, d: partition.broadcast_copies(_part_rows(_sensor(sp, d)), COPIES),
    "part_global": lambda sp, d: partition.single_partition(
        _sensor(sp, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))),
    "part_by_key": lambda sp, d: _part_rows(partition.by_key(_sensor(sp, d), "id")),
    "part_custom": lambda sp, d: partition.with_partition_id(
        partition.custom_partition(_sensor(sp, d).select("arrival", "id"), "id", PARTS)),
    # rolling aggregates
    "wordcount": lambda sp, d: rolling.wordcount(_tokens(sp, d)),
    "wordcount_running": lambda sp, d: rolling.running_count_uneven(
        _tokens(sp, d), "word", ["doc_id", "line_no", "word_pos"],
        density_chunk(read_table(sp, d, "documents"), "doc_id", target_rows=DOCS_PER_CHUNK)),
    "rolling_sum": lambda sp, d: rolling.rolling_sum(_sensor(sp, d)),
    "rolling_max": lambda sp, d: rolling.rolling_max(_sensor(sp, d)),
    "rolling_max_by": lambda sp, d: rolling.rolling_max_by(_sensor(sp, d)),
    "rolling_min": lambda sp, d: rolling.rolling_max(_sensor(sp, d), use_min=True),
    "rolling_min_by": lambda sp, d: rolling.rolling_max_by(_sensor(sp, d), use_min=True),
    "rolling_reduce": lambda sp, d: rolling.rolling_reduce(_sensor(sp, d)),
    # windows
    "win_tumbling": lambda sp, d: windows.tumbling_agg(_sensor(sp, d), TUMBLE),
    "win_sliding": lambda sp, d: windows.sliding_agg(_sensor(sp, d), SLIDE_SIZE, SLIDE_STEP),
    "win_sliding_uneven": lambda sp, d: windows.sliding_agg(_sensor(sp, d), UNEVEN_SIZE, UNEVEN_STEP),
    "win_session": lambda sp, d: windows.session_agg(_sensor(sp, d), SESSION_GAP),
    "win_count_tumbling": lambda sp, d: windows.count_window_tumbling(_sensor(sp, d), COUNT_SIZE),
    "win_count_sliding": lambda sp, d: windows.count_window_sliding(_sensor(sp, d), COUNT_SIZE, COUNT_SLIDE),
    "win_global": lambda sp, d: windows.global_window(_sensor(sp, d)),
    "win_reduce": lambda sp, d: windows.window_reduce(_sensor(sp, d), TUMBLE),
    "win_aggregate": lambda sp, d: windows.window_aggregate_string(_sensor(sp, d), TUMBLE),
    "win_process": lambda sp, d: windows.window_process(_sensor(sp, d), TUMBLE),
    "win_aggregate_meta": lambda sp, d: windows.tumbling_agg(_sensor(sp, d), META_TUMBLE),
    "win_all": lambda sp, d: windows.tumbling_agg(_sensor(sp, d), TUMBLE, keys=()),
    # watermarks and late data
    "watermark_trace": lambda sp, d: _traced(sp, d).select("arrival", "arr_ms", "ts_ms", "wm_before", "wm_after"),
    "watermark_periodic": lambda sp, d: lateness.periodic_watermark(_jitter(sp, d), PERIODIC_EVERY, DELAY).select(
        "arrival", "arrival_no", "epoch", "wm_periodic"),
    "late_flag": lambda sp, d: lateness.late_flag(_traced(sp, d)).select("arrival", "ts_ms", "wm_before", "is_late"),
    "win_allowed_lateness": lambda sp, d: lateness.window_firings(_classified(sp, d)),
    "late_side_output": lambda sp, d: _classified(sp, d).where(F.col("lateness") == lateness.CLOSED).select(
        "arrival", "id", "ts_ms", "vc"),
    "watermark_monotonic": lambda sp, d: lateness.watermark_trace(
        _jitter(sp, d), 0, keep=["arrival", "arr_ms", "ts_ms"]).select(
        "arrival", "arr_ms", "ts_ms", "wm_before", "wm_after"),
    "late_side_output_sliding": lambda sp, d: lateness.side_output_sliding(
        _traced(sp, d, "id", "vc"), LATE_SIZE, LATE_STEP, LATE_LATENESS).select("arrival", "id", "ts_ms", "vc"),
    "timer_event": lambda sp, d: lateness.event_timer_first_fire(_sensor(sp, d), TIMER_AT, DELAY),
    "timer_rearmed": lambda sp, d: timers.event_timers(_clock(sp, d), F.lit(TIMER_AT), DELAY),
    "timer_hourly": lambda sp, d: timers.event_timers(_clock(sp, d), F.expr(HOURLY), DELAY),
    # global windows with a trigger
    "win_global_trigger": lambda sp, d: triggers.global_window_trigger(_sensor(sp, d), TRIGGER),
    "win_global_trigger_keep": lambda sp, d: triggers.global_window_trigger(_sensor(sp, d), TRIGGER_KEEP, purge=False),
    "win_global_trigger_interval": lambda sp, d: triggers.global_window_trigger(_sensor(sp, d), TRIGGER_TIME),
    # joins
    "join_window": lambda sp, d: joins.window_join(*_sides(sp, d), WINDOW_JOIN),
    "join_interval": lambda sp, d: joins.interval_join_bucketed(*_sides(sp, d), -INTERVAL, INTERVAL),
    "join_interval_bucketed": lambda sp, d: joins.interval_join_bucketed(*_sides(sp, d), -INTERVAL, INTERVAL),
    "join_connect": lambda sp, d: joins.connect_join_ttl(*_sides(sp, d), CONNECT_TTL).select("id", "l_arrival", "r_arrival"),
    "join_broadcast_threshold": lambda sp, d: joins.asof_threshold(
        _sensor(sp, d).where(F.col("event_type") != "signup"),
        _sensor(sp, d).where(F.col("event_type") == "signup").withColumnRenamed("vc", "threshold")),
    "join_broadcast_lookup": lambda sp, d: joins.asof_lookup(
        _data(_sensor(sp, d)), _config(_sensor(sp, d)), "event_type").where(F.col("vc") * BIG > F.coalesce("value", F.lit(0))),
    "join_broadcast_map": lambda sp, d: joins.asof_entries(
        _data(_sensor(sp, d)), _config(_sensor(sp, d)), list(ENTRIES)),
    # keyed state
    "state_jump_alert": lambda sp, d: state.jump_alert(_sensor(sp, d), threshold=JUMP),
    "state_top3": lambda sp, d: state.running_top_k(_sensor(sp, d), TOP_K_STATE),
    "state_value_counts": lambda sp, d: state.value_counts_running(_sensor(sp, d)),
    "state_map_snapshots": lambda sp, d: state.map_snapshots(state.map_deltas(_sensor(sp, d), SNAPSHOT), SNAPSHOT),
    "state_value_counts_final": lambda sp, d: state.value_counts_final(_sensor(sp, d)),
    "state_running_sum": lambda sp, d: state.running_sum(_sensor(sp, d)),
    "state_running_avg": lambda sp, d: state.running_avg(_sensor(sp, d)),
    "state_ttl": lambda sp, d: state.ttl_state(_sensor(sp, d), TTL),
    "state_bucket_count": lambda sp, d: state.bucket_running_count(_sensor(sp, d), BUCKETS),
    # NULL is a key like any other
    "rolling_sum_null_key": lambda sp, d: rolling.rolling_sum(_no_key(_sensor(sp, d))),
    "state_running_sum_null_key": lambda sp, d: state.running_sum(_no_key(_sensor(sp, d))),
    "state_top3_null_key": lambda sp, d: state.running_top_k(_no_key(_sensor(sp, d)), TOP_K_STATE),
    "win_process_null_key": lambda sp, d: windows.window_process(_no_key(_sensor(sp, d)), TUMBLE),
    "win_count_sliding_null_key": lambda sp, d: windows.count_window_sliding(_no_key(_sensor(sp, d)), COUNT_SIZE, COUNT_SLIDE),
    "win_count_sliding_null_value": lambda sp, d: windows.count_window_sliding(_some_values(_sensor(sp, d)), COUNT_SIZE, COUNT_SLIDE),
    "win_allowed_lateness_null_key": lambda sp, d: _firings(_no_key(_jitter(sp, d))),
    # top-N
    "topn_window_all": lambda sp, d: topn.topn_all_window(_sensor(sp, d), TOP_N, SLIDE_SIZE, SLIDE_STEP),
    "topn_window_keyed": lambda sp, d: topn.topn_keyed(_sensor(sp, d), TOP_N, SLIDE_SIZE, SLIDE_STEP),
    "topn_window_pruned": lambda sp, d: topn.topn_pruned(_sensor(sp, d), TOP_N, SLIDE_SIZE, SLIDE_STEP),
    # sinks (row shaping and round trips)
    "kafka_value_rows": lambda sp, d: sinks.kafka_value_rows(sensor_lines(_sensor(sp, d)), id_col="rec"),
    "kafka_keyed_rows": lambda sp, d: sinks.kafka_keyed_rows(sensor_lines(_sensor(sp, d)), TOPIC),
    "sink_file_roundtrip": _file_roundtrip,
}


# --- DuckDB oracle ------------------------------------------------------------

SENSOR = ("SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ts_ms, "
          "CAST(floor(value) AS INTEGER) AS vc, event_id AS arrival, event_type FROM events")
JITTER = (f"SELECT *, ts_ms + ((arrival * {JITTER_MULT}) % {JITTER_MOD}) * {JITTER_STEP_MS} AS arr_ms "
          f"FROM ({SENSOR})")
LINES = ("SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_no, "
         "unnest(string_split(text, chr(10))) AS value FROM documents")
TOKENS = (f"SELECT doc_id, line_no, CAST(generate_subscripts(w, 1) AS BIGINT) AS word_pos, unnest(w) AS word FROM ("
          f"SELECT doc_id, line_no, CASE WHEN value = '' THEN [''] "
          f"WHEN rtrim(value, ' ') = '' THEN CAST([] AS VARCHAR[]) "
          f"ELSE string_split(rtrim(value, ' '), ' ') END AS w FROM ({LINES}))")
SLINES = (f"SELECT 'events' AS source, arrival AS rec, CAST(0 AS BIGINT) AS pos, "
          f"id || ',' || CAST(ts_ms AS VARCHAR) || ',' || CAST(vc AS VARCHAR) AS value FROM ({SENSOR})")
CAND = f"{SLINES} UNION ALL SELECT 'documents', doc_id, line_no, value FROM ({LINES})"
PARSED = (f"SELECT source, rec, pos, value, f[1] AS id, "
          f"CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN TRY_CAST(f[2] AS BIGINT) END AS ts, "
          f"CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN TRY_CAST(f[3] AS INTEGER) END AS vc, nf FROM ("
          f"SELECT *, string_split(value, ',') AS f, "
          f"len(string_split(regexp_replace(value, ',+$', ''), ',')) AS nf FROM ({CAND}))")
W_ID = "PARTITION BY id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_LEFT = ", ".join(f"'{t}'" for t in LEFT_TYPES)
LEFT = f"SELECT * FROM ({SENSOR}) WHERE event_type IN ({_LEFT})"
RIGHT = f"SELECT * FROM ({SENSOR}) WHERE event_type NOT IN ({_LEFT})"


def _tumble(size, src=SENSOR):
    return f"SELECT *, ts_ms - ts_ms % {size} AS w_start, ts_ms - ts_ms % {size} + {size} AS w_end FROM ({src})"


def _slide(size, step, src=SENSOR):
    return (f"SELECT *, w_start + {size} AS w_end FROM (SELECT *, "
            f"unnest(range((ts_ms - {size}) // {step} + 1, ts_ms // {step} + 1)) * {step} AS w_start FROM ({src}))")


def _win_cs(src, keys):
    k = ", ".join(keys + ["w_start", "w_end"])
    return f"SELECT {k}, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc FROM ({src}) GROUP BY {k}"


TRACED = (f"SELECT *, max(ts_ms) OVER (ORDER BY arr_ms, arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
          f"- {DELAY + 1} AS wm_before, max(ts_ms) OVER (ORDER BY arr_ms, arrival ROWS BETWEEN UNBOUNDED PRECEDING "
          f"AND CURRENT ROW) - {DELAY + 1} AS wm_after FROM ({JITTER})")
CLASSIFIED = (f"SELECT *, CASE WHEN wm_before IS NULL OR w_end - 1 > wm_before THEN 'on_time' "
              f"WHEN wm_before < w_end - 1 + {LATENESS} THEN 'allowed' ELSE 'closed' END AS lateness "
              f"FROM ({_tumble(TUMBLE, TRACED)})")
TOPN_COUNTS = f"SELECT w_start, w_end, vc, count(*) AS cnt FROM ({_slide(SLIDE_SIZE, SLIDE_STEP)}) GROUP BY ALL"
TOPN = (f"SELECT w_start, w_end, rank, vc, cnt FROM (SELECT *, row_number() OVER (PARTITION BY w_start "
        f"ORDER BY cnt DESC, vc ASC) AS rank FROM ({TOPN_COUNTS})) WHERE rank <= {TOP_N}")
PARTROWS = f"SELECT arrival, id, vc FROM ({SENSOR})"

ORACLE = {
    "src_text": LINES,
    "src_generator": "SELECT event_id AS i, 'Number:' || CAST(event_id AS VARCHAR) AS value FROM events",
    "parse_sensor_lines": (f"SELECT source, rec, pos, id, ts, vc FROM ({PARSED}) "
                           f"WHERE nf >= 3 AND ts IS NOT NULL AND vc IS NOT NULL"),
    "parse_sensor_rejects": (f"SELECT source, rec, pos, value, CASE WHEN nf < 3 THEN 'missing_fields' "
                             f"WHEN ts IS NULL THEN 'bad_ts' ELSE 'bad_vc' END AS reason FROM ({PARSED}) "
                             f"WHERE nf < 3 OR ts IS NULL OR vc IS NULL"),
    "map_project": f"SELECT arrival, id FROM ({SENSOR})",
    "filter_eq": f"SELECT arrival, id, ts_ms, vc FROM ({SENSOR}) WHERE id = '{FILTER_ID}'",
    "flatmap_conditional": (f"SELECT arrival, CAST(generate_subscripts(a, 1) AS BIGINT) AS out_pos, unnest(a) AS value "
                            f"FROM (SELECT arrival, CASE event_type WHEN 'click' THEN [CAST(vc AS BIGINT)] "
                            f"WHEN 'view' THEN [ts_ms, CAST(vc AS BIGINT)] ELSE CAST([] AS BIGINT[]) END AS a "
                            f"FROM ({SENSOR}))"),
    "tokenize_lines": TOKENS,
    "map_increment": f"SELECT arrival, vc + 1 AS value FROM ({SENSOR})",
    "split_even": f"SELECT arrival, vc FROM ({SENSOR}) WHERE vc % 2 = 0",
    "split_odd": f"SELECT arrival, vc FROM ({SENSOR}) WHERE vc % 2 = 1",
    "route_main": f"SELECT arrival, id, event_type FROM ({SENSOR}) WHERE event_type NOT IN ('click', 'purchase')",
    "route_tagged": (f"SELECT arrival, id, CASE event_type WHEN 'click' THEN 'tag1' ELSE 'tag2' END AS route "
                     f"FROM ({SENSOR}) WHERE event_type IN ('click', 'purchase')"),
    "alarm_threshold": f"SELECT arrival, id, vc FROM ({SENSOR}) WHERE vc > {ALARM}",
    "scalar_bundle": (f"SELECT arrival, abs(vc - 250) AS abs_diff, (vc - 250) % 7 AS mod7, "
                      f"'id:' || id || '/' || CAST(vc AS VARCHAR) AS label, "
                      f"strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_text, "
                      f"least(vc, 100) AS lo, greatest(vc, 100) AS hi FROM ({SENSOR})"),
    "part_random": PARTROWS,
    "part_round_robin": PARTROWS,
    "part_rescale": PARTROWS,
    "part_broadcast": f"SELECT CAST(c AS INTEGER) AS copy, arrival, id, vc FROM ({PARTROWS}), range({COPIES}) t(c)",
    "part_global": f"SELECT event_type, count(*) AS cnt FROM ({SENSOR}) GROUP BY event_type",
    "part_by_key": PARTROWS,
    "part_custom": (f"SELECT arrival, id, CAST(((CAST(id AS BIGINT) % {PARTS}) + {PARTS}) % {PARTS} AS INTEGER) AS pid "
                    f"FROM ({SENSOR})"),
    "wordcount": f"SELECT word, count(*) AS cnt FROM ({TOKENS}) GROUP BY word",
    "wordcount_running": (f"SELECT doc_id, line_no, word_pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, "
                          f"line_no, word_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM ({TOKENS})"),
    "rolling_sum": (f"SELECT arrival, id, first_value(ts_ms) OVER ({W_ID}) AS ts_ms, "
                    f"CAST(sum(vc) OVER ({W_ID}) AS BIGINT) AS vc FROM ({SENSOR})"),
    "rolling_max": (f"SELECT arrival, id, first_value(ts_ms) OVER ({W_ID}) AS ts_ms, "
                    f"max(vc) OVER ({W_ID}) AS vc FROM ({SENSOR})"),
    "rolling_max_by": (f"SELECT arrival, id, r.t AS ts_ms, r.v AS vc FROM (SELECT arrival, id, "
                       f"max({{'v': vc, 'o': -arrival, 't': ts_ms}}) OVER ({W_ID}) AS r FROM ({SENSOR}))"),
    "rolling_min": (f"SELECT arrival, id, first_value(ts_ms) OVER ({W_ID}) AS ts_ms, "
                    f"min(vc) OVER ({W_ID}) AS vc FROM ({SENSOR})"),
    "rolling_min_by": (f"SELECT arrival, id, r.t AS ts_ms, r.v AS vc FROM (SELECT arrival, id, "
                       f"min({{'v': vc, 'o': arrival, 't': ts_ms}}) OVER ({W_ID}) AS r FROM ({SENSOR}))"),
    "rolling_reduce": f"SELECT arrival, id, ts_ms, CAST(sum(vc) OVER ({W_ID}) AS BIGINT) AS vc FROM ({SENSOR})",
    "win_tumbling": _win_cs(_tumble(TUMBLE), ["id"]),
    "win_sliding": _win_cs(_slide(SLIDE_SIZE, SLIDE_STEP), ["id"]),
    "win_sliding_uneven": _win_cs(_slide(UNEVEN_SIZE, UNEVEN_STEP), ["id"]),
    "win_session": (f"SELECT id, min(ts_ms) AS s_start, max(ts_ms) + {SESSION_GAP} AS s_end, count(*) AS cnt, "
                    f"CAST(sum(vc) AS BIGINT) AS sum_vc FROM (SELECT *, sum(nw) OVER (PARTITION BY id ORDER BY ts_ms, "
                    f"arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess FROM (SELECT *, CASE WHEN "
                    f"lag(ts_ms) OVER (PARTITION BY id ORDER BY ts_ms, arrival) IS NULL OR ts_ms - lag(ts_ms) OVER "
                    f"(PARTITION BY id ORDER BY ts_ms, arrival) > {SESSION_GAP} THEN 1 ELSE 0 END AS nw "
                    f"FROM ({SENSOR}))) GROUP BY id, sess"),
    "win_count_tumbling": (f"SELECT id, (rn - 1) // {COUNT_SIZE} AS win_no, count(*) AS cnt, CAST(sum(vc) AS BIGINT) "
                           f"AS sum_vc, min(arrival) AS first_arrival, max(arrival) AS last_arrival FROM (SELECT *, "
                           f"row_number() OVER (PARTITION BY id ORDER BY arrival) AS rn FROM ({SENSOR})) "
                           f"GROUP BY id, win_no HAVING count(*) = {COUNT_SIZE}"),
    "win_count_sliding": (f"SELECT id, rn AS pos, arrival AS fire_arrival, least(rn, {COUNT_SIZE}) AS cnt, sum_vc FROM "
                          f"(SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrival) AS rn, CAST(sum(vc) OVER "
                          f"(PARTITION BY id ORDER BY arrival ROWS BETWEEN {COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) "
                          f"AS BIGINT) AS sum_vc FROM ({SENSOR})) WHERE rn % {COUNT_SLIDE} = 0"),
    "win_global": f"SELECT id, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc FROM ({SENSOR}) GROUP BY id",
    "win_reduce": (f"SELECT id, w_start, w_end, arg_max(ts_ms, arrival) AS ts_ms, CAST(sum(vc) AS BIGINT) AS vc "
                   f"FROM ({_tumble(TUMBLE)}) GROUP BY ALL"),
    "win_aggregate": (f"SELECT id, w_start, w_end, CAST(sum(vc) AS VARCHAR) AS agg_out "
                      f"FROM ({_tumble(TUMBLE)}) GROUP BY ALL"),
    "win_process": (f"SELECT id, w_start, w_end, count(*) OVER (PARTITION BY id, w_start) AS cnt, arrival, ts_ms, vc "
                    f"FROM ({_tumble(TUMBLE)})"),
    "win_aggregate_meta": _win_cs(_tumble(META_TUMBLE), ["id"]),
    "win_all": _win_cs(_tumble(TUMBLE), []),
    "watermark_trace": f"SELECT arrival, arr_ms, ts_ms, wm_before, wm_after FROM ({TRACED})",
    "watermark_periodic": (f"SELECT r.arrival, r.arrival_no, r.epoch, e.wm AS wm_periodic FROM (SELECT *, "
                           f"(arrival_no - 1) // {PERIODIC_EVERY} AS epoch FROM (SELECT *, row_number() OVER "
                           f"(ORDER BY arr_ms, arrival) AS arrival_no FROM ({JITTER}))) r JOIN (SELECT epoch, "
                           f"max(emax) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - "
                           f"{DELAY + 1} AS wm FROM (SELECT (arrival_no - 1) // {PERIODIC_EVERY} AS epoch, "
                           f"max(ts_ms) AS emax FROM (SELECT *, row_number() OVER (ORDER BY arr_ms, arrival) AS "
                           f"arrival_no FROM ({JITTER})) GROUP BY 1)) e ON r.epoch = e.epoch"),
    "late_flag": (f"SELECT arrival, ts_ms, wm_before, coalesce(ts_ms < wm_before, false) AS is_late "
                  f"FROM ({TRACED})"),
    "win_allowed_lateness": (
        f"WITH c AS ({CLASSIFIED}), "
        f"b AS (SELECT id, w_start, w_end, count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS sum_vc FROM c "
        f"WHERE lateness = 'on_time' GROUP BY ALL), "
        f"l AS (SELECT id, w_start, w_end, count(*) OVER w AS k, sum(vc) OVER w AS ls FROM c "
        f"WHERE lateness = 'allowed' WINDOW w AS (PARTITION BY id, w_start ORDER BY arr_ms, arrival "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) "
        f"SELECT id, w_start, w_end, CAST(0 AS BIGINT) AS firing, cnt, sum_vc FROM b UNION ALL "
        f"SELECT l.id, l.w_start, l.w_end, l.k AS firing, coalesce(b.cnt, 0) + l.k AS cnt, "
        f"CAST(coalesce(b.sum_vc, 0) + l.ls AS BIGINT) AS sum_vc FROM l LEFT JOIN b "
        f"ON l.id IS NOT DISTINCT FROM b.id AND l.w_start = b.w_start"),
    "late_side_output": f"SELECT arrival, id, ts_ms, vc FROM ({CLASSIFIED}) WHERE lateness = 'closed'",
    "timer_event": (f"SELECT id, CAST({TIMER_AT} AS BIGINT) AS timer_ms, CASE WHEN x IS NULL THEN NULL "
                    f"ELSE greatest(min(arrival), x) END AS fired_at FROM ({SENSOR}), "
                    f"(SELECT min(arrival) AS x FROM ({SENSOR}) WHERE ts_ms >= {TIMER_AT + DELAY + 1}) GROUP BY id, x"),
    "join_window": (f"SELECT l.id, l.w_start, l.w_end, l.arrival AS l_arrival, l.ts_ms AS l_ts_ms, "
                    f"r.arrival AS r_arrival, r.ts_ms AS r_ts_ms, r.vc AS r_vc FROM ({_tumble(WINDOW_JOIN, LEFT)}) l "
                    f"JOIN ({_tumble(WINDOW_JOIN, RIGHT)}) r ON l.id = r.id AND l.w_start = r.w_start"),
    "join_interval": (f"SELECT l.id, l.arrival AS l_arrival, l.ts_ms AS l_ts_ms, r.arrival AS r_arrival, "
                      f"r.ts_ms AS r_ts_ms, r.vc AS r_vc FROM ({LEFT}) l JOIN ({RIGHT}) r ON l.id = r.id "
                      f"AND r.ts_ms BETWEEN l.ts_ms - {INTERVAL} AND l.ts_ms + {INTERVAL}"),
    "join_connect": (f"SELECT l.id, l.arrival AS l_arrival, r.arrival AS r_arrival FROM ({LEFT}) l "
                     f"JOIN ({RIGHT}) r ON l.id = r.id AND abs(l.ts_ms - r.ts_ms) < {CONNECT_TTL}"),
    "join_broadcast_threshold": (
        f"SELECT arrival, id, vc, threshold FROM (SELECT *, coalesce(last_value(th IGNORE NULLS) OVER (ORDER BY "
        f"arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS threshold FROM (SELECT arrival, id, vc, "
        f"CASE WHEN event_type = 'signup' THEN vc END AS th, event_type <> 'signup' AS is_data FROM ({SENSOR}))) "
        f"WHERE is_data AND vc > threshold"),
    "state_jump_alert": (f"SELECT arrival, id, vc, prev_vc FROM (SELECT *, lag(vc, 1, 0) OVER (PARTITION BY id ORDER BY "
                         f"arrival) AS prev_vc FROM ({SENSOR})) WHERE abs(vc - prev_vc) > {JUMP}"),
    "state_top3": (f"SELECT arrival, id, vc, t[1] AS top1, t[2] AS top2, t[3] AS top3 FROM (SELECT arrival, id, vc, "
                   f"list_sort(list(vc) OVER ({W_ID}), 'DESC') AS t FROM ({SENSOR}))"),
    "state_value_counts": (f"SELECT arrival, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY arrival ROWS BETWEEN "
                           f"UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM ({SENSOR})"),
    "state_map_snapshots": (
        f"WITH r AS (SELECT id, vc, arrival, row_number() OVER (PARTITION BY id ORDER BY arrival) AS pos FROM ({SENSOR})) "
        f"SELECT e.id, e.pos // {SNAPSHOT} - 1 AS segment, e.arrival, r.vc, count(*) AS cnt FROM r e JOIN r ON r.id = e.id "
        f"AND r.pos <= e.pos WHERE e.pos % {SNAPSHOT} = 0 GROUP BY ALL"),
    "state_value_counts_final": f"SELECT id, vc, count(*) AS cnt FROM ({SENSOR}) GROUP BY id, vc",
    "state_running_sum": f"SELECT arrival, id, vc, CAST(sum(vc) OVER ({W_ID}) AS BIGINT) AS sum_vc FROM ({SENSOR})",
    "state_running_avg": (f"SELECT arrival, id, vc, CAST(sum(vc) OVER ({W_ID}) AS DOUBLE) / count(vc) OVER ({W_ID}) "
                          f"AS avg_vc FROM ({SENSOR})"),
    "state_ttl": (f"SELECT arrival, id, ts_ms, vc, last_value(CASE WHEN vc > 10 THEN vc END IGNORE NULLS) OVER "
                  f"(PARTITION BY id, island ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state "
                  f"FROM (SELECT *, sum(brk) OVER ({W_ID}) AS island FROM (SELECT *, CASE WHEN lag(ts_ms) OVER "
                  f"(PARTITION BY id ORDER BY arrival) IS NULL OR ts_ms - lag(ts_ms) OVER (PARTITION BY id ORDER BY "
                  f"arrival) >= {TTL} THEN 1 ELSE 0 END AS brk FROM ({SENSOR})))"),
    "state_bucket_count": (f"SELECT arrival, CAST(arrival % {BUCKETS} AS INTEGER) AS bucket, count(*) OVER (PARTITION BY "
                           f"arrival % {BUCKETS} ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt "
                           f"FROM ({SENSOR})"),
    "topn_window_all": TOPN,
    "topn_window_keyed": TOPN,
    "topn_window_pruned": TOPN,
    "kafka_value_rows": f"SELECT value, CAST(rec AS VARCHAR) AS dedup_id FROM ({SLINES})",
    "kafka_keyed_rows": f"SELECT '{TOPIC}' AS topic, split_part(value, ',', 1) AS key, value FROM ({SLINES})",
    "sink_file_roundtrip": (f"SELECT id || ',' || CAST(ts_ms AS VARCHAR) || ',' || CAST(vc AS VARCHAR) AS value, "
                            f"strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H') AS bucket_hour FROM ({SENSOR})"),
}
ORACLE["join_interval_bucketed"] = ORACLE["join_interval"]
ORACLE["watermark_monotonic"] = ORACLE["watermark_trace"].replace(f"- {DELAY + 1} AS", "- 1 AS")
ORACLE["late_side_output_sliding"] = (
    f"SELECT arrival, id, ts_ms, vc FROM ({TRACED}) WHERE wm_before IS NOT NULL AND "
    f"ts_ms - ts_ms % {LATE_STEP} + {LATE_SIZE} - 1 + {LATE_LATENESS} <= wm_before")
_SENSOR_NO_KEY = f"SELECT CASE WHEN event_type <> '{NO_KEY_TYPE}' THEN id END AS id, ts_ms, vc, arrival, event_type FROM ({SENSOR})"
for _name in ("rolling_sum", "state_running_sum", "state_top3", "win_process", "win_count_sliding", "win_allowed_lateness"):
    ORACLE[f"{_name}_null_key"] = ORACLE[_name].replace(f"({SENSOR})", f"({_SENSOR_NO_KEY})")
ORACLE["win_count_sliding_null_value"] = ORACLE["win_count_sliding"].replace(
    f"({SENSOR})", f"(SELECT id, ts_ms, CASE WHEN vc % 10 >= 7 THEN vc END AS vc, arrival, event_type FROM ({SENSOR}))")


def _timer_oracle(at: str) -> str:
    """Registrations against the moves of the watermark: the nearest move at or above each due value."""
    return (f"WITH t AS ({TRACED}), m AS (SELECT wm_after AS wm, arrival AS fired_at FROM t "
            f"WHERE wm_before IS NULL OR wm_after > wm_before), "
            f"r AS (SELECT id, CAST({at} AS BIGINT) AS timer_ms, greatest({at}, coalesce(wm_before + 1, {at})) AS due FROM t) "
            f"SELECT id, timer_ms, fired_at, wm, count(*) AS registered FROM r ASOF LEFT JOIN m ON r.due <= m.wm GROUP BY ALL")


def _trigger_oracle(trigger: triggers.Trigger, purge: bool) -> str:
    key = "PARTITION BY id ORDER BY arrival"
    before = f"({key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    cut = [trigger.when or "false"]
    if trigger.every_ms:
        cut.append(f"coalesce(ts_ms // {trigger.every_ms} > max(ts_ms) OVER {before} // {trigger.every_ms}, false)")
    count = f" OR (rn - coalesce(last, 0)) % {trigger.count} = 0" if trigger.count else ""
    per = (f"WITH c AS (SELECT *, row_number() OVER ({key}) AS rn, {' OR '.join(cut)} AS cut FROM ({SENSOR})), "
           f"l AS (SELECT *, max(CASE WHEN cut THEN rn END) OVER {before} AS last FROM c), "
           f"f AS (SELECT *, cut{count} AS fires FROM l), "
           f"n AS (SELECT *, coalesce(count(*) FILTER (fires) OVER {before}, 0) AS firing FROM f), "
           f"g AS (SELECT id, firing, max(CASE WHEN fires THEN arrival END) AS fire_arrival, count(*) AS cnt, "
           f"CAST(sum(vc) AS BIGINT) AS sum_vc, min(arrival) AS first_arrival FROM n GROUP BY id, firing) ")
    if purge:
        return per + "SELECT id, firing, fire_arrival, cnt, sum_vc, first_arrival FROM g WHERE fire_arrival IS NOT NULL"
    return per + ("SELECT id, firing, fire_arrival, CAST(sum(cnt) OVER w AS BIGINT) AS cnt, CAST(sum(sum_vc) OVER w AS BIGINT) AS sum_vc, "
                  "min(first_arrival) OVER w AS first_arrival FROM g WHERE fire_arrival IS NOT NULL "
                  "WINDOW w AS (PARTITION BY id ORDER BY firing ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


ORACLE["timer_rearmed"] = _timer_oracle(str(TIMER_AT))
ORACLE["timer_hourly"] = _timer_oracle(f"(ts_ms - ts_ms % {HOUR} + {HOUR})")
ORACLE["win_global_trigger"] = _trigger_oracle(TRIGGER, True)
ORACLE["win_global_trigger_keep"] = _trigger_oracle(TRIGGER_KEEP, False)
ORACLE["win_global_trigger_interval"] = _trigger_oracle(TRIGGER_TIME, True)
_CONFIG = (f"SELECT arrival, ['click', 'view', 'purchase'][arrival % 3 + 1] AS name, {{'v': CASE WHEN vc % 5 <> 0 THEN "
           f"vc * CAST({BIG} AS BIGINT) END}} AS put FROM ({SENSOR}) WHERE event_type = 'signup'")
_DATA = f"SELECT arrival, id, event_type, vc FROM ({SENSOR}) WHERE event_type <> 'signup'"
ORACLE["join_broadcast_lookup"] = (
    f"SELECT d.arrival, d.id, d.event_type, d.vc, put.v AS value FROM ({_DATA}) d ASOF LEFT JOIN ({_CONFIG}) c "
    f"ON d.event_type = c.name AND d.arrival >= c.arrival WHERE d.vc * CAST({BIG} AS BIGINT) > coalesce(put.v, 0)")
ORACLE["join_broadcast_map"] = f"SELECT d.arrival, d.id, d.event_type, d.vc, " + ", ".join(
    f"{n}.put.v AS {n}" for n in ENTRIES) + f" FROM ({_DATA}) d " + " ".join(
    f"ASOF LEFT JOIN (SELECT * FROM ({_CONFIG}) WHERE name = '{n}') {n} ON d.arrival >= {n}.arrival" for n in ENTRIES)


def _session_oracle() -> str:
    """The rows of each key one by one, in arrival order, into a list of its kept sessions."""
    gap, keep = SESSION_LATE_GAP, SESSION_LATE_KEPT
    shown = "STRUCT(s BIGINT, e BIGINT, n BIGINT, v BIGINT)[]"
    entry = "STRUCT(s BIGINT, e BIGINT, n BIGINT, v BIGINT, change INTEGER, cause BIGINT)[]"

    def log(x: str, cause: str) -> str:
        row = "{{'s': y.s, 'e': y.e, 'n': y.n, 'v': y.v, 'change': CAST({} AS INTEGER), 'cause': {}}}"
        return (f"list_concat(list_transform({x}.shown, lambda y: {row.format(-1, cause)}), "
                f"list_transform([{x}], lambda y: {row.format(1, cause)}))")

    def fired(x: str) -> str:
        now = f"'s': {x}.s, 'e': {x}.e, 'n': {x}.n, 'v': {x}.v"
        return f"{{{now}, 'done': true, 'shown': [{{{now}}}]}}"

    near = f"(x.s <= t + {gap} AND x.e >= t)"
    due = "NOT x.done AND x.e - 1 <= wm"
    return f"""
        WITH RECURSIVE q AS (SELECT id, ts_ms AS t, vc, arrival, wm_before + {DELAY - SESSION_LATE_DELAY} AS wm,
            row_number() OVER (PARTITION BY id ORDER BY arr_ms, arrival) AS pos FROM ({TRACED})),
        step(id, pos, live, out) AS (
            SELECT DISTINCT id, CAST(0 AS BIGINT),
                   CAST([] AS STRUCT(s BIGINT, e BIGINT, n BIGINT, v BIGINT, done BOOLEAN, shown {shown})[]), CAST([] AS {entry}) FROM q
            UNION ALL
            SELECT id, pos, CASE WHEN m IS NULL THEN rest WHEN m.done THEN list_append(rest, {fired('m')}) ELSE list_append(rest, m) END,
                   CASE WHEN m.done THEN list_concat(fires, {log('m', 'arrival')}) ELSE fires END
            FROM (SELECT *, CASE WHEN len(touch) > 0 OR wm IS NULL OR t + {gap - 1 + keep} > wm THEN
                         {{'s': s, 'e': e, 'n': n, 'v': v, 'done': coalesce(e - 1 <= wm, false), 'shown': shown}} END AS m
            FROM (SELECT *, least(t, list_min(list_transform(touch, lambda x: x.s))) AS s,
                         greatest(t + {gap}, list_max(list_transform(touch, lambda x: x.e))) AS e,
                         CAST(1 + coalesce(list_sum(list_transform(touch, lambda x: x.n)), 0) AS BIGINT) AS n,
                         CAST(list_sum(list_append(list_transform(touch, lambda x: x.v), vc)) AS BIGINT) AS v,
                         flatten(list_transform(touch, lambda x: x.shown)) AS shown
            FROM (SELECT *, list_filter(kept, lambda x: {near}) AS touch, list_filter(kept, lambda x: NOT {near}) AS rest
            FROM (SELECT q.*, list_filter(list_transform(live, lambda x: CASE WHEN {due} THEN {fired('x')} ELSE x END),
                                          lambda x: wm IS NULL OR x.e - 1 + {keep} > wm) AS kept,
                         flatten(list_transform(list_filter(live, lambda x: {due}), lambda x: {log('x', 'CAST(NULL AS BIGINT)')})) AS fires
                  FROM step JOIN q ON q.id IS NOT DISTINCT FROM step.id AND q.pos = step.pos + 1))))),
        ends AS (SELECT id, flatten(list_transform(list_filter(arg_max(live, pos), lambda x: NOT x.done),
                        lambda x: {log('x', 'CAST(NULL AS BIGINT)')})) AS out FROM step GROUP BY id)
        SELECT id, c.s AS s_start, c.e AS s_end, c.n AS cnt, c.v AS sum_vc, c.change AS change, c.cause AS cause
        FROM (SELECT id, unnest(out) AS c FROM (SELECT id, out FROM step UNION ALL SELECT id, out FROM ends))"""


def _session_changelog(spark, d):
    return sessions.session_changelog(_jitter(spark, d), SESSION_LATE_GAP, SESSION_LATE_DELAY, SESSION_LATE_KEPT)


# Queries whose operator replays reduced records in arrival order, in Arrow batches: no form of
# joins and windows is known for them.  All other queries run without Python (tests/test_plans.py).
REPLAYED = {
    "win_session_changelog": _session_changelog,
    "win_session_late": lambda sp, d: sessions.final_sessions(_session_changelog(sp, d)),
}
REPLAYED_ORACLE = {
    "win_session_changelog": _session_oracle(),
    "win_session_late": (f"SELECT id, s_start, s_end, cnt, sum_vc FROM (SELECT *, unnest(range(CAST(n AS BIGINT))) FROM (SELECT id, "
                         f"s_start, s_end, cnt, sum_vc, sum(change) AS n FROM ({_session_oracle()}) GROUP BY ALL) WHERE n > 0)"),
}
