"""Timers with every firing, and global windows with triggers: the batch forms
against row-by-row simulations, the streams against the batch forms."""

import random

import pytest
from pyspark.sql import functions as F

from streamops.operators import timers, triggers
from streamops.operators.triggers import Trigger
from streamops.sources.tables import sensor, with_jitter
from streamops.streaming import processors as P
from streamops.streaming import store
from streamops.streaming import timers as ST
from streamops.streaming.sinks import idempotent_parquet_sink
from streamops.streaming.sources import events_stream
from tests.conftest import SF001
from tests.stream_util import split_events
from tests.test_streaming import run_to_memory

HOUR, MIN = 3_600_000, 60_000
SCHEMA = "id string, ts_ms bigint, vc int, arr_ms bigint, arrival bigint"


def rows_in(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(rng, n, span=400, spread=60, nulls=False):
    out = []
    for a in range(n):
        t = None if nulls and rng.random() < 0.1 else rng.randrange(span) + a * spread // 10
        out.append((rng.choice(["a", "a", "a", "b", None]), t, None if rng.random() < 0.3 else rng.randrange(20), a * 7, a))
    return out


def simulate_timers(rows, at, delay):
    """The timer service row by row: a sorted list of armed timers, fired at each move of the watermark."""
    armed, out, top = {}, [], None
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        when = at(r)
        if when is not None:
            armed[r[0], when] = armed.get((r[0], when), 0) + 1
        if r[1] is not None and (top is None or r[1] > top):
            top = r[1]
            wm = top - delay - 1
            for k in sorted((k for k in armed if k[1] <= wm), key=str):
                out.append((*k, r[4], wm, armed.pop(k)))
    return sorted(out + [(*k, None, None, n) for k, n in armed.items()], key=str)


@pytest.mark.parametrize("width", [None, 1, 37])
@pytest.mark.parametrize("delay", [0, 50])
def test_every_firing_of_timers(spark, width, delay):
    for seed in range(2):
        rows = table(random.Random(seed), 150, nulls=seed == 1)
        df = spark.createDataFrame(rows, SCHEMA)
        for expr, at in ((F.lit(300), lambda r: 300), (F.lit(-5), lambda r: -5),
                         (F.expr("(ts_ms - pmod(ts_ms, 40)) + 40"), lambda r: None if r[1] is None else r[1] // 40 * 40 + 40),
                         (F.expr("IF(vc > 10, ts_ms + vc, NULL)"), lambda r: r[1] + r[2] if r[1] is not None and (r[2] or 0) > 10 else None)):
            got = timers.event_timers(df, expr, delay, chunk_width=width)
            assert rows_in(got.select("id", "timer_ms", "fired_at", "wm", "registered")) == simulate_timers(rows, at, delay)


def test_a_fixed_timer_is_armed_again_after_it_fired(spark):
    rows = [("a", t, 1, i, i) for i, t in enumerate([1000, 5000, 9000, 6000, 9500, 9400, 10000, 7000])]
    got = timers.event_timers(spark.createDataFrame(rows, SCHEMA), F.lit(5000), 3000)
    assert [(r["fired_at"], r["wm"], r["registered"]) for r in got.orderBy("fired_at").collect()] == [
        (None, None, 1), (2, 5999, 3), (4, 6499, 2), (6, 6999, 2)]


def test_timers_of_no_rows(spark):
    assert rows_in(timers.event_timers(spark.createDataFrame([], SCHEMA), F.lit(5), 0)) == []


HOURLY = "(ts_ms - pmod(ts_ms, 3600000)) + 3600000"


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_timers_equal_the_batch_form(spark, tmp_path, parts):
    src, _ = split_events(SF001, parts, jitter=True)
    out, root = str(tmp_path / "out"), str(tmp_path / "timers")
    q = (with_jitter(events_stream(spark, src)).writeStream
         .foreachBatch(ST.timer_batches(F.expr(HOURLY), 30 * MIN, root, idempotent_parquet_sink(out)))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    cols = ["id", "timer_ms", "fired_at", "wm", "registered"]
    want = timers.event_timers(with_jitter(sensor(spark, SF001)), F.expr(HOURLY), 30 * MIN).select(*cols)
    assert rows_in(spark.read.parquet(out).select(*cols)) == rows_in(want.where("fired_at is not null"))
    left = ST.pending(spark, root, parts - 1).groupBy("id", "timer_ms").agg(F.sum("n").alias("n"))
    assert rows_in(left) == rows_in(want.where("fired_at is null").select("id", "timer_ms", "registered"))


def test_a_replayed_timer_batch_gives_the_same_firings(spark, tmp_path):
    rows = table(random.Random(5), 90)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    run = ST.timer_batches(F.expr("ts_ms + 30"), 20, str(tmp_path), lambda d, i: got.setdefault(i, []).append(rows_in(d)))
    for i in range(3):
        batch = df.where((F.col("arrival") >= 30 * i) & (F.col("arrival") < 30 * (i + 1)))
        run(batch, i)
        run(batch, i)                                  # as after a lost commit
    assert all(a == b for a, b in got.values())
    cols = ["id", "timer_ms", "fired_at", "wm", "registered"]
    want = timers.event_timers(df, F.expr("ts_ms + 30"), 20).where("fired_at is not null").select(*cols)
    assert sorted((x for a, _ in got.values() for x in a), key=str) == rows_in(want)
    store.remove(spark, f"{tmp_path}/carry={1:012d}")
    with pytest.raises(FileNotFoundError):
        run(df, 2)


# --- global window with a trigger ---------------------------------------------

RULES = [Trigger(count=4), Trigger(when="vc > 12"), Trigger(every_ms=100), Trigger(when="vc > 12", count=3),
         Trigger(when="vc > 15", every_ms=90, count=5), Trigger(when="vc is null")]


def simulate_trigger(rows, trigger, purge):
    by, out = {}, []
    for r in sorted(rows, key=lambda r: r[4]):
        st = by.setdefault(r[0], {"rows": [], "since": 0, "top": None, "n": 0})
        st["rows"].append(r)
        st["since"] += 1
        cut = {"vc > 12": (r[2] or 0) > 12, "vc > 15": (r[2] or 0) > 15, "vc is null": r[2] is None, None: False}[trigger.when]
        if trigger.every_ms and r[1] is not None:
            cut = cut or st["top"] is not None and r[1] // trigger.every_ms > st["top"] // trigger.every_ms
        if r[1] is not None:
            st["top"] = r[1] if st["top"] is None else max(st["top"], r[1])
        if cut or trigger.count and st["since"] == trigger.count:
            some = [x[2] for x in st["rows"] if x[2] is not None]
            out.append((r[0], st["n"], r[4], len(st["rows"]), sum(some) if some else None, st["rows"][0][4]))
            st["n"] += 1
            st["since"] = 0
            if purge:
                st["rows"] = []
    return sorted(out, key=str)


@pytest.mark.parametrize("purge", [True, False])
@pytest.mark.parametrize("trigger", RULES, ids=str)
def test_triggers_against_a_simulation(spark, trigger, purge):
    rows = table(random.Random(7), 160, nulls=True)
    df = spark.createDataFrame(rows, SCHEMA)
    for width in (None, 9):
        got = triggers.global_window_trigger(df, trigger, purge, width=width)
        assert rows_in(got) == simulate_trigger(rows, trigger, purge)


def test_trigger_needs_a_rule(spark):
    for bad in ({}, {"count": -1}, {"every_ms": -3}):
        with pytest.raises(ValueError):
            Trigger(**bad)
    assert rows_in(triggers.global_window_trigger(spark.createDataFrame([], SCHEMA), Trigger(count=2))) == []


@pytest.mark.parametrize("parts,purge,trigger", [
    (1, True, Trigger(when="vc > 90", every_ms=24 * HOUR, count=3)), (3, True, Trigger(when="vc > 90", every_ms=24 * HOUR, count=3)),
    (10, True, Trigger(when="vc > 90", every_ms=24 * HOUR, count=3)), (3, False, Trigger(count=4)), (10, False, Trigger(when="vc > 70")),
    (10, True, Trigger(every_ms=48 * HOUR))], ids=str)
def test_stream_triggers_equal_the_batch_form(spark, parts, purge, trigger):
    src, _ = split_events(SF001, parts)
    stream = P.GlobalTrigger.with_own(events_stream(spark, src), trigger)
    got = run_to_memory(P.apply(stream, "id", P.GlobalTrigger(trigger, purge)))
    want = triggers.global_window_trigger(sensor(spark, SF001), trigger, purge)
    assert rows_in(want) and rows_in(got.select(*want.columns)) == rows_in(want)
