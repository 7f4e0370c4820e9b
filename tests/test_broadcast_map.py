"""Broadcast state as a map, count windows over NULLs, and publication of
batches: batch forms against simulations, streams against batch forms."""

import random

import pytest
from pyspark.sql import functions as F

from streamops.operators import joins, windows
from streamops.sources.tables import sensor
from streamops.streaming import lateness as SL
from streamops.streaming import asof, sinks
from streamops.streaming.sources import events_stream
from tests.conftest import SF001
from tests.stream_util import split_events

BIG = 5_000_000_000


def rows_in(df):
    return sorted(map(tuple, df.collect()), key=str)


def frames(spark, rng, n, value):
    data, config = [], []
    for a in rng.sample(range(10 * n), n):
        if rng.random() < 0.2:
            config.append((a, rng.choice(["low", "high", "c", None]), None if rng.random() < 0.3 else value(rng)))
        else:
            data.append((a, rng.choice(["low", "high", "c", "none", None]), rng.randrange(100)))
    return data, config


def simulate(data, config):
    state, out = {}, []
    for r in sorted([(a, 1, k, v) for a, k, v in data] + [(a, 0, k, v) for a, k, v in config], key=lambda r: r[:2]):
        if r[1] == 0:
            state[r[2]] = r[3]
        else:
            out.append((r[0], r[2], r[3], dict(state)))
    return out


@pytest.mark.parametrize("kind,value", [("bigint", lambda r: BIG + r.randrange(9)), ("string", lambda r: f"v{r.randrange(9)}"),
                                        ("double", lambda r: r.random()), ("array<int>", lambda r: [r.randrange(9)])])
@pytest.mark.parametrize("width", [None, 11])
def test_lookup_of_entries(spark, kind, value, width):
    data, config = frames(spark, random.Random(3), 200, value)
    d = spark.createDataFrame(data, "arrival bigint, entry string, vc int")
    c = spark.createDataFrame(config, f"arrival bigint, name string, value {kind}")
    want = simulate(data, config)
    got = joins.asof_lookup(d, c, "entry", width=width)
    assert got.schema["value"].dataType == c.schema["value"].dataType
    assert rows_in(got) == sorted(((a, k, v, st.get(k)) for a, k, v, st in want), key=str)
    got = joins.asof_entries(d, c, ["low", "high", "never"], width=width)
    assert rows_in(got) == sorted(((a, k, v, st.get("low"), st.get("high"), None) for a, k, v, st in want), key=str)


def test_config_comes_before_data_of_the_same_order(spark):
    d = spark.createDataFrame([(5, "k", 1), (4, "k", 2)], "arrival bigint, entry string, vc int")
    c = spark.createDataFrame([(5, "k", BIG)], "arrival bigint, name string, value bigint")
    assert rows_in(joins.asof_lookup(d, c, "entry")) == [(4, "k", 2, None), (5, "k", 1, BIG)]


def test_big_thresholds(spark):
    s = sensor(spark, SF001)
    config = s.where("event_type = 'signup'").select("arrival", F.lit(BIG).alias("threshold"))
    got = joins.asof_threshold(s.where("event_type <> 'signup'"), config)
    assert dict(got.dtypes)["threshold"] == "bigint"
    first = s.where("event_type = 'signup'").agg(F.min("arrival")).first()[0]
    assert got.count() == s.where((F.col("arrival") < first) & (F.col("vc") > 0)).count()


def names(df):
    s = df.where("event_type = 'signup'")
    return s.select("arrival", F.element_at(F.array(*map(F.lit, ("click", "view", "purchase"))), (F.col("arrival") % 3 + 1).cast("int")).alias("name"),
                    F.when(F.col("vc") % 5 != 0, F.col("vc") * BIG).alias("value"))


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_lookup_equals_the_batch_form(spark, tmp_path, parts):
    src, _ = split_events(SF001, parts)
    config = names(sensor(spark, SF001))
    out, root = str(tmp_path / "out"), str(tmp_path / "entries")
    data = events_stream(spark, src).where("event_type <> 'signup'")
    q = (data.writeStream.foreachBatch(asof.lookup_batches(config, sinks.idempotent_parquet_sink(out), root, "event_type"))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    want = joins.asof_lookup(sensor(spark, SF001).where("event_type <> 'signup'"), config, "event_type")
    assert rows_in(spark.read.parquet(out).select(*want.columns)) == rows_in(want)
    assert want.where("value is not null").count() and want.where("value is null").count()


# --- sliding count windows over NULLs -------------------------------------------

@pytest.mark.parametrize("size,slide", [(5, 2), (1, 1), (2, 3), (7, 1), (50, 4)])
@pytest.mark.parametrize("width", [None, 1, 6])
def test_sliding_count_windows_evaluate_the_frame(spark, size, slide, width):
    rng = random.Random(size)
    rows = [(rng.choice(["a", "a", "b", None]), a, None if 20 < a < 60 or rng.random() < 0.4 else rng.randrange(-9, 9)) for a in range(120)]
    df = spark.createDataFrame(rows, "id string, arrival bigint, vc int")
    want, seen = [], {}
    for k, a, v in rows:
        seen.setdefault(k, []).append(v)
        n = len(seen[k])
        if n % slide == 0:
            some = [x for x in seen[k][-size:] if x is not None]
            want.append((k, n, a, min(n, size), sum(some) if some else None))
    assert rows_in(windows.count_window_sliding(df, size, slide, width=width)) == sorted(want, key=str)


# --- a batch is published once ------------------------------------------------

def test_replay_before_the_commit_leaves_window_counts(spark, tmp_path):
    """The second stage has read a batch whose commit was lost; the replay of
    the first stage must not give it the rows again."""
    hour, minute = 3_600_000, 60_000
    rows = [("a", hour + i, 1, hour + i, i) for i in range(10)]
    batch = spark.createDataFrame(rows, "id string, ts_ms bigint, vc int, arr_ms bigint, arrival bigint")
    routed = str(tmp_path / "routed")
    stage = SL.classify_batches(str(tmp_path / "carry"), 30 * minute, hour, 20 * minute, SL.routed_rows_sink(routed))
    stage(batch, 0)
    schema = spark.read.parquet(routed).drop("batch_id").schema
    ck = str(tmp_path / "ck")

    def counts():
        got = []
        q = (SL.window_updates(spark, routed, schema, hour, 30 * minute, 20 * minute).writeStream.outputMode("update")
             .foreachBatch(lambda d, i: got.extend(r["cnt"] for r in d.collect())).option("checkpointLocation", ck).start())
        q.processAllAvailable()
        q.stop()
        return got

    assert counts() == [10]
    files = {f.name for f in (tmp_path / "routed" / "batch_id=0").iterdir()}
    stage(batch, 0)                                    # as after a crash before the checkpoint's commit
    assert {f.name for f in (tmp_path / "routed" / "batch_id=0").iterdir()} == files
    assert counts() == []                              # nothing new to read


def test_half_written_attempts_are_never_seen(spark, tmp_path):
    out = str(tmp_path / "out")
    b = sensor(spark, SF001).limit(50)
    bad = b.withColumn("x", F.when(F.col("arrival") >= 0, F.raise_error(F.lit("lost"))).cast("string"))
    w = sinks.idempotent_parquet_sink(out)
    with pytest.raises(Exception):
        w(bad, 0)
    w(b, 1)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 1
    w(b, 0)
    assert spark.read.parquet(out).count() == 100


def test_late_side_output_has_rows(spark):
    from streamops.catalog import QUERIES
    assert QUERIES["late_side_output_sliding"](spark, SF001).count() > 0
