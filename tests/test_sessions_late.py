"""Sessions with late data: the changelog against a row-by-row simulation, the
stream against the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from streamops.catalog import REPLAYED, REPLAYED_ORACLE
from streamops.operators import sessions, windows
from streamops.operators.lateness import watermark_trace
from streamops.sources.tables import sensor, with_jitter
from streamops.streaming import sessions as SS
from streamops.streaming import store
from streamops.streaming.sinks import idempotent_parquet_sink
from streamops.streaming.sources import events_stream
from tests.conftest import SF001, SF01
from tests.oracle import compare
from tests.stream_util import split_events
from tests.test_oracle import SPARK_TO_DUCK
from tests.test_plans import plan_of

MIN = 60_000
SCHEMA = "id string, ts_ms bigint, vc int, arr_ms bigint, arrival bigint"


def rows_in(df):
    return sorted(map(tuple, df.collect()), key=str)


def simulate(rows, gap, delay, lateness):
    """Every row in arrival order into the sessions of its key; the watermark fires after each row."""
    live, out, top = {}, [], None

    def fire(k, s, cause):
        out.extend((k, *x, -1, cause) for x in s["shown"])
        vals = [v for v in s["vals"] if v is not None]
        s["shown"] = [(s["lo"], s["hi"], len(s["vals"]), sum(vals) if vals else None)]
        out.append((k, *s["shown"][0], 1, cause))
        s["fired"] = True

    for k, t, v, _, a in sorted(rows, key=lambda r: (r[3], r[4])):
        if t is None:
            continue
        wm = None if top is None else top - delay - 1
        mine = live.setdefault(k, [])
        touch = [s for s in mine if s["lo"] <= t + gap and t <= s["hi"]]
        if touch or wm is None or t + gap - 1 + lateness > wm:
            new = {"lo": min([t] + [s["lo"] for s in touch]), "hi": max([t + gap] + [s["hi"] for s in touch]), "fired": False,
                   "vals": [v] + [x for s in touch for x in s["vals"]], "shown": [x for s in touch for x in s["shown"]]}
            live[k] = [s for s in mine if s not in touch] + [new]
            if wm is not None and new["hi"] - 1 <= wm:
                fire(k, new, a)
        if top is None or t > top:
            top = t
            for k2, all_of in live.items():
                for s in all_of:
                    if not s["fired"] and s["hi"] - 1 <= top - delay - 1:
                        fire(k2, s, None)
                live[k2] = [s for s in all_of if s["hi"] - 1 + lateness > top - delay - 1]
    before_end = list(out)
    for k, all_of in live.items():
        for s in all_of:
            if not s["fired"]:
                fire(k, s, None)
    return sorted(out, key=str), sorted(before_end, key=str)


def table(seed, n=160, step=6, spread=150, nulls=False):
    rng, out = random.Random(seed), []
    for a in range(n):
        t = None if nulls and rng.random() < 0.08 else a * step + rng.randrange(-spread, 20)
        out.append((rng.choice("aaab") if not nulls or rng.random() < 0.8 else None, t,
                    None if rng.random() < 0.2 else rng.randrange(20), a * 3, a))
    return out


TABLES = {1: {}, 2: {"spread": 40, "step": 9}, 3: {"nulls": True}, 4: {"step": 20, "spread": 300}}


@pytest.mark.parametrize("gap,delay,lateness,width,seeds", [(10, 5, 30, 29, (1, 3)), (40, 20, 0, None, (2, 4)), (25, 0, 60, 29, (3, 2)),
                                                            (7, 60, 200, None, (1, 4)), (90, 30, 15, 29, (4, 3))])
def test_changelog_equals_a_simulation(spark, gap, delay, lateness, width, seeds):
    kinds = set()
    for seed in seeds:
        rows = table(seed, **TABLES[seed])
        got = sessions.session_changelog(spark.createDataFrame(rows, SCHEMA), gap, delay, lateness, chunk_width=width)
        want = simulate(rows, gap, delay, lateness)[0]
        assert rows_in(got) == want
        kinds |= {(r[5], r[6] is None) for r in want}
    assert lateness < 30 or {(1, True), (1, False), (-1, False)} <= kinds


def test_a_late_row_bridges_two_fired_sessions(spark):
    rows = [("a", t, 1, i, i) for i, t in enumerate([0, 20, 100, 10, 101])]
    got = sessions.session_changelog(spark.createDataFrame(rows, SCHEMA), 10, 0, 1000)
    assert rows_in(got) == sorted([("a", 0, 10, 1, 1, 1, None), ("a", 20, 30, 1, 1, 1, None), ("a", 0, 10, 1, 1, -1, 3),
                                   ("a", 20, 30, 1, 1, -1, 3), ("a", 0, 30, 3, 3, 1, 3), ("a", 100, 111, 2, 2, 1, None)], key=str)
    assert rows_in(sessions.final_sessions(got)) == [("a", 0, 30, 3, 3), ("a", 100, 111, 2, 2)]


def test_a_rejected_row_and_a_row_saved_by_a_kept_session(spark):
    rows = [("a", t, 1, i, i) for i, t in enumerate([0, 100, 2, 50, 92])]
    got = sessions.final_sessions(sessions.session_changelog(spark.createDataFrame(rows, SCHEMA), 10, 0, 0))
    assert rows_in(got) == [("a", 0, 10, 1, 1), ("a", 92, 110, 2, 2)]


def test_without_closing_the_changelog_leaves_the_sessions_of_all_rows(spark):
    s = with_jitter(sensor(spark, SF001))
    got = sessions.final_sessions(sessions.session_changelog(s, 40 * MIN, 10 * MIN, 10**15))
    assert rows_in(got.select("id", "s_start", "s_end", "cnt", "sum_vc")) == rows_in(
        windows.session_agg(s, 40 * MIN).select("id", "s_start", "s_end", "cnt", "sum_vc"))


def test_a_hot_key_is_replayed_by_buckets_and_late_rows(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("id"), (F.col("id") * 5 - F.when(F.col("id") % 500 == 0, 300).otherwise(
        F.col("id") * 7 % 40)).alias("ts_ms"), F.lit(1).alias("vc"), F.col("id").alias("arr_ms"), F.col("id").alias("arrival"))
    recs = sessions.records(watermark_trace(rows, 50), 1000)
    late = rows.where("arrival % 500 = 0").count()
    buckets = recs.where("cnt > 0").select("_b").distinct().count()
    assert recs.agg(F.sum("cnt")).first()[0] == 20_000 and recs.count() <= 4 * (buckets + late) < 1000
    got = sessions.session_changelog(rows, 1000, 50, 500)
    assert rows_in(got) == simulate([tuple(r) for r in rows.collect()], 1000, 50, 500)[0]


def test_no_rows_and_a_gap_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_in(sessions.session_changelog(empty, 10, 0, 0)) == []
    with pytest.raises(ValueError):
        sessions.session_changelog(empty, 0, 0, 0)


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_equals_the_batch_form(spark, tmp_path, parts):
    gap, delay, lateness = 40 * MIN, 10 * MIN, 30 * MIN
    src, _ = split_events(SF001, parts, jitter=True)
    out, root = str(tmp_path / "out"), str(tmp_path / "sessions")
    q = (with_jitter(events_stream(spark, src)).writeStream
         .foreachBatch(SS.session_batches(gap, delay, lateness, root, idempotent_parquet_sink(out)))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    s = with_jitter(sensor(spark, SF001)).select("id", "ts_ms", "vc", "arr_ms", "arrival")
    all_of, before_end = simulate([tuple(r) for r in s.collect()], gap, delay, lateness)
    assert rows_in(sessions.session_changelog(s, gap, delay, lateness)) == all_of
    cols = ["id", "s_start", "s_end", "cnt", "sum_vc", "change", "cause"]
    assert rows_in(spark.read.parquet(out).select(*cols)) == before_end
    waiting = SS.open_sessions(spark, root, parts - 1).where("not done").select("key", "lo", F.col("hi") + gap, "cnt", "total")
    left = sorted(all_of, key=str)
    for r in before_end:
        left.remove(r)
    assert rows_in(waiting) == sorted((r[:5] for r in left if r[5] == 1), key=str)


def test_a_replayed_batch_gives_the_same_changes(spark, tmp_path):
    rows = table(7, 120)
    df, got = spark.createDataFrame(rows, SCHEMA), {}
    run = SS.session_batches(15, 10, 80, str(tmp_path), lambda d, i: got.setdefault(i, []).append(rows_in(d)))
    for i in range(4):
        batch = df.where((F.col("arrival") >= 30 * i) & (F.col("arrival") < 30 * (i + 1)))
        run(batch, i)
        run(batch, i)                                  # as after a lost commit
    assert all(a == b for a, b in got.values())
    assert sorted((x for a, _ in got.values() for x in a), key=str) == simulate(rows, 15, 10, 80)[1]
    store.remove(spark, f"{tmp_path}/batch={2:012d}")
    with pytest.raises(FileNotFoundError):
        run(df, 3)


@pytest.mark.parametrize("name", sorted(REPLAYED))
def test_queries_match_their_sql(spark, con01, name):
    df = REPLAYED[name](spark, SF01)
    ok, msg = compare(df, con01, REPLAYED_ORACLE[name])
    assert ok, msg
    rel = con01.sql(REPLAYED_ORACLE[name])
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema} == dict(zip(rel.columns, map(str, rel.types)))
    assert not any(bad in plan_of(df) for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython"))


def test_the_query_enters_every_case(spark, con01):
    seen = con01.sql(f"SELECT change, cause IS NULL, count(*) FROM ({REPLAYED_ORACLE['win_session_changelog']}) GROUP BY ALL").fetchall()
    assert {x[:2] for x in seen} == {(1, True), (1, False), (-1, True), (-1, False)}
    rows = con01.sql(f"SELECT sum(cnt) FROM ({REPLAYED_ORACLE['win_session_late']})").fetchall()[0][0]
    assert rows < con01.sql("SELECT count(*) FROM events").fetchall()[0][0]     # some are rejected
