"""The paced source, the two-phase sink, the consumer's de-duplication, the
delta-encoded map and the state kept in a checkpoint."""

import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from streamops.operators import state
from streamops.sources.tables import sensor
from streamops.streaming import processors as P
from streamops.streaming import twophase
from streamops.streaming.numbers import Numbers, PacedReader, paced_numbers
from streamops.streaming.sources import consume_once, events_stream, header_id
from tests.conftest import SF001
from tests.stream_util import split_events
from tests.test_streaming import run_to_memory, run_to_parquet


def options(**kw):
    return {"n": "100", "rowsPerSecond": "10", "readers": "3", "startMs": "0", **{k: str(v) for k, v in kw.items()}}


def test_offsets_are_paced_and_bounded(monkeypatch):
    now = [1_000_000.0]
    monkeypatch.setattr(time, "time", lambda: now[0])
    r = PacedReader(options(startMs=1_000_000_000))
    seen = []
    for dt in (0, 0.25, 1, -5, 2, 100):
        now[0] += dt
        seen.append(r.latestOffset()["at"])
    assert seen == [0, 2, 12, 12, 12, 100]             # a clock set back takes nothing back
    parts = r.partitions({"at": 2}, {"at": 12})
    assert [(p.first, p.end) for p in parts] == [(2, 5), (5, 8), (8, 12)]
    assert r.partitions({"at": 12}, {"at": 12}) == []
    got = [x for p in parts for b in r.read(p) for x in b.to_pylist()]
    assert got == [{"i": i, "value": f"Number:{i}"} for i in range(2, 12)]
    assert [b.num_rows for b in r.read(Numbers(0, 25_000))] == [10_000, 10_000, 5_000]
    for bad in ({"n": -1}, {"rowsPerSecond": 0}):
        with pytest.raises(ValueError):
            PacedReader(options(**bad))


def test_each_number_once_over_a_restart(spark, tmp_path):
    n, rate, folder = 120, 10, str(tmp_path / "numbers")
    out, ck, schema = str(tmp_path / "out"), str(tmp_path / "ck"), "i bigint, value string"

    def given():
        return sorted(r["i"] for r in spark.read.schema(schema).parquet(out).collect()) if os.path.exists(f"{out}/_spark_metadata/0") else []

    def run(until):
        q = paced_numbers(spark, n, folder, rate, readers=3).writeStream.format("parquet").option(
            "checkpointLocation", ck).trigger(processingTime="200 milliseconds").start(out)
        end = time.time() + 90
        while len(given()) < until and time.time() < end:
            time.sleep(0.3)
        try:
            q.stop()
        except StreamingQueryException:                # stopped in the middle of a batch, like a crash
            pass
        return given()

    start = time.time()
    got = run(1)
    assert got == list(range(len(got))) and 0 < len(got) <= rate * (time.time() - start)
    assert run(len(got) + 1) == list(range(len(given())))
    assert run(n) == list(range(n))
    assert {r["value"] for r in spark.read.schema(schema).parquet(out).collect()} == {f"Number:{i}" for i in range(n)}


# --- two-phase sink -------------------------------------------------------------

def lines_in(tmp_path, parts):
    src = tmp_path / "in"
    src.mkdir()
    for i, p in enumerate(parts):
        f = src / f"{i:03d}.txt"
        f.write_text("\n".join(p))
        os.utime(f, (time.time() - 1000 + i,) * 2)
    return str(src)


def stream(spark, src):
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)


def finish(q):
    q.processAllAvailable()
    q.stop()


def test_a_batch_run_again_after_its_commit_adds_nothing(spark, tmp_path):
    want = [f"line {i}" for i in range(40)]
    src, root, ck = lines_in(tmp_path, [want[:15], want[15:]]), str(tmp_path / "out"), tmp_path / "ck"
    finish(twophase.write_committed_lines(stream(spark, src), root, str(ck)))
    assert sorted(r["value"] for r in twophase.read_committed(spark, root).collect()) == sorted(want)
    files = sorted(os.listdir(f"{root}/lines"))
    for f in ((ck / "commits" / "1"), (ck / "commits" / ".1.crc")):    # as after a crash before Spark's own commit
        if f.exists():
            f.unlink()
    finish(twophase.write_committed_lines(stream(spark, src), root, str(ck)))
    assert sorted(r["value"] for r in twophase.read_committed(spark, root).collect()) == sorted(want)
    assert sorted(os.listdir(f"{root}/lines")) == files


def test_a_task_that_fails_after_its_write_leaves_no_row_twice(spark, tmp_path):
    """The writer's calls are logged; the first attempt of one task fails in close."""
    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    flag = str(tmp_path / "failed")

    class Fragile(twophase.LineWriter):
        def note(self, what):
            with open(log, "a") as f:
                f.write(json.dumps([self.partition_id, self.at, what]) + "\n")

        def open(self, partition_id):
            self.partition_id, self.at = partition_id, time.time()
            self.note("open")
            super().open(partition_id)

        def write(self, row):
            self.note("write")
            super().write(row)

        def close(self):
            staged = super().close()
            if staged["rows"] and not os.path.exists(flag):
                open(flag, "w").close()
                raise OSError("lost after the write")
            self.note("close")
            return staged

        def discard(self):
            self.note("discard")
            super().discard()

    base = twophase.committed_lines(root)
    hooks = base({}).streamWriter(None, False)
    sink = twophase.two_phase_sink("fragile_lines", lambda: Fragile(root), hooks.on_commit, hooks.on_abort)
    spark.dataSource.register(sink)
    want = [f"line {i}" for i in range(30)]
    src = lines_in(tmp_path, [want[:10], want[10:]])

    def run():
        return stream(spark, src).repartition(3).writeStream.format("fragile_lines").option(
            "checkpointLocation", str(tmp_path / "ck")).start()

    q = run()
    with pytest.raises(Exception):
        q.processAllAvailable()
    q.stop()
    assert not os.path.exists(f"{root}/manifests") or not os.listdir(f"{root}/manifests")
    finish(run())
    assert Counter(r["value"] for r in twophase.read_committed(spark, root).collect()) == Counter(want)
    calls = {}
    for line in open(log):
        p, at, what = json.loads(line)
        calls.setdefault((p, at), []).append(what)
    for c in calls.values():
        assert c[0] == "open" and c[-1] in ("close", "discard") and set(c[1:-1]) <= {"write"}
    assert sum(c[-1] == "discard" for c in calls.values()) >= 1


# --- consumer ---------------------------------------------------------------------

def test_doubled_records_are_consumed_once(spark, tmp_path):
    src, _ = split_events(SF001, 4, closing=True)
    ev = events_stream(spark, src)
    doubled = ev.withColumn("event_time", F.timestamp_millis("ts_ms")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    headers = F.array(F.struct(F.lit("other").alias("key"), F.lit(b"x").alias("value")),
                      F.struct(F.lit("dedup_id").alias("key"), F.col("arrival").cast("string").cast("binary").alias("value")))
    once = consume_once(header_id(doubled.withColumn("headers", headers)), within="6 hours")
    name = "once_" + tmp_path.name.replace("-", "_")
    q = once.select("arrival").writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    kept = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    got = Counter(r["arrival"] for r in spark.table(name).collect())
    assert set(got.values()) == {1} and len(got) == sensor(spark, SF001).count() + 2
    assert kept < 100                                  # ids older than the span have left


def test_records_without_an_id_are_all_kept(spark):
    rows = [("2024-01-01 00:00:00", None), ("2024-01-01 00:00:00", None), ("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:02", "a")]
    df = spark.createDataFrame(rows, "t string, dedup_id string").select(F.to_timestamp("t").alias("event_time"), "dedup_id")
    path = f"/tmp/once-{random.getrandbits(48):x}"
    df.write.parquet(path)
    got = run_to_memory(consume_once(spark.readStream.schema(df.schema).parquet(path)))
    assert sorted(str(r["dedup_id"]) for r in got.collect()) == ["None", "None", "a"]


# --- map state as changes and snapshots ---------------------------------------------

@pytest.mark.parametrize("every", [1, 4, 50])
def test_the_map_can_be_made_again_at_any_row(spark, every):
    rng = random.Random(every)
    rows = [(rng.choice(["a", "a", None, "b"]), i * 3, rng.choice([1, 2, 3, None])) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, arrival bigint, vc int")
    deltas = state.map_deltas(df, every, width=17).persist()
    snaps = state.map_snapshots(deltas, every).persist()
    assert deltas.count() == len(rows)
    by = {}
    for k, o, v in rows:
        by.setdefault(k, []).append((o, v))
    want = {(k, s, seq[(s + 1) * every - 1][0], v): n for k, seq in by.items() for s in range(len(seq) // every)
            for v, n in Counter(v for _, v in seq[:(s + 1) * every]).items()}
    assert {tuple(r)[:4]: r["cnt"] for r in snaps.collect()} == want and snaps.count() == len(want)
    for k, o in ((rows[i][0], rows[i][1]) for i in (0, 13, 55, 89)):
        got = {r["vc"]: r["cnt"] for r in state.map_at(deltas, snaps, k, o).collect()}
        assert got == Counter(v for x, v in by[k] if x <= o)


# --- state in a checkpoint -----------------------------------------------------------

def test_counters_are_read_back_from_the_checkpoint(spark, tmp_path):
    src, _ = split_events(SF001, 3)
    st = events_stream(spark, src).withColumn("bucket", F.pmod("arrival", F.lit(4)).cast("int"))
    run_to_parquet(P.apply(st, "bucket", P.BucketCount()), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(tuple(r) for r in P.stored_state(spark, str(tmp_path / "ck"), "n").collect())
    want = state.bucket_running_count(sensor(spark, SF001), 4).groupBy("bucket").agg(F.max("cnt").alias("n"))
    assert got == sorted(tuple(r) for r in want.collect()) and sum(n for _, n in got) == sensor(spark, SF001).count()
