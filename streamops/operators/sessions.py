"""Event-time sessions with late data, as a changelog (W6 with WM7, WM8).

A row spans ``[t, t + gap)``; spans that touch are one session.  The watermark
is per event (``lateness``).  A session fires when the watermark reaches its last
millisecond, is kept for ``lateness_ms`` more, and then closed.  A row may

* extend or start an open session,
* bridge sessions: they become one, and what they had shown is taken back when
  the merged session fires,
* come late for a session that has fired and is still kept: it fires again at once,
* be late for itself (its own span is past the allowed lateness) and touch no kept
  session: it is rejected.

The changelog has a row for each firing (``change`` 1) and, before it, one for each
earlier result that it replaces (``change`` -1); the sum of changes is the final
sessions.  ``cause`` is the arrival of the late row that fired it, NULL where the
watermark or the end of the input did.

Plan.  What a session holds when it fires depends on the order of arrival, so some
rows are replayed in that order, but few of them have to be:

1. Rows above the watermark at their arrival, in one gap-wide bucket of time, are
   one record.  They touch each other, and no session with one of them can fire
   before the watermark has passed the bucket's end, when all of them are there;
   so how many they are and how far right they reach can be told at the first.
   Only a row that reaches further left than the bucket's earlier ones (it may touch
   a session that is about to be closed) is a record of its own, found by a
   chunked scan of the bucket's running minimum; in time order there are none.
2. Rows behind the watermark stay single.
3. Records meet in islands: runs of buckets, late rows included, with no gap
   between them.  No session, however merged, reaches over an island's edge.
4. Each island is replayed in arrival order: one shuffle by (key, island), sorted
   on disk, read once; in memory are the sessions that are still kept.

So a key costs at most range / gap records and its late rows, however many rows
it has, and it is split at every gap.  A key without any gap is one island: its
records (not its rows) go through one task.

Defined results: rows without a time are left out; NULL is a key like any other;
rows that arrive at one place in the order are taken in no fixed order; NULL values
count and add nothing (a session of NULL values sums to NULL); no rows give no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streamops.operators.lateness import watermark_trace
from streamops.plans.scan import Agg, chunk_for, chunk_of, prefix_scan

SHOWN = "array<struct<s: bigint, e: bigint, cnt: bigint, total: bigint>>"


def records(traced: DataFrame, gap_ms: int, key: str = "id", time: str = "ts_ms", value: str = "vc",
            arrival: tuple[str, ...] = ("arr_ms", "arrival"), chunk: Column | None = None) -> DataFrame:
    """What has to be replayed of the rows: bucket totals, rows that reach
    further left in their bucket, rows behind the watermark.  ``chunk``, if given,
    is a chunk number of the order of arrival."""
    t, at = F.col(time), F.struct(*arrival)
    rows = traced.where(t.isNotNull()).withColumn("_b", chunk_of(time, gap_ms))
    behind = F.coalesce(t <= F.col("wm_before"), F.lit(False))
    fixed = [F.lit(False).alias("done"), F.lit(None).cast(SHOWN).alias("shown")]

    def record(lo, hi, cnt, total, wm, when):
        return [F.col(key).alias("key"), F.col("_b"), lo.alias("lo"), hi.alias("hi"), cnt.cast("bigint").alias("cnt"),
                total.cast("bigint").alias("total"), wm.alias("wm"), when.alias("at"), *fixed]

    ahead = rows.where(~behind)
    totals = ahead.groupBy(key, "_b").agg(
        F.min(F.struct(at.alias("at"), t.alias("t"), F.col("wm_before").alias("wm"))).alias("_first"), F.max(t).alias("_hi"),
        F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    first = F.col("_first")
    left = prefix_scan(ahead, [key, "_b"], list(arrival), chunk if chunk is not None else chunk_for(traced, arrival[0]),
                       [Agg("_low", "min", t, inclusive=False)], keep=[key, "_b", time, "wm_before", *arrival])
    none = F.lit(None)
    return (totals.select(*record(first["t"], F.col("_hi"), F.col("_n"), F.col("_v"), first["wm"], first["at"]))
            .unionByName(left.where(t < F.col("_low")).select(*record(t, t, F.lit(0), none, F.col("wm_before"), at)))
            .unionByName(rows.where(behind).select(*record(t, t, F.lit(1), F.col(value), F.col("wm_before"), at))))


def islands(recs: DataFrame, gap_ms: int) -> DataFrame:
    """The records with their island: what starts in one bucket touches, so
    the ordered window runs over buckets only."""
    spans = recs.groupBy(F.col("key").alias("_key"), F.col("_b").alias("_at")).agg(
        F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    w = Window.partitionBy("_key").orderBy("_at")
    reach = F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("_lo") - reach > gap_ms), 1).otherwise(0)
    spans = spans.withColumn("_new", new).withColumn(
        "island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).select("_key", "_at", "island")
    return recs.join(spans, recs["key"].eqNullSafe(spans["_key"]) & (recs["_b"] == spans["_at"])).drop("_key", "_at")


def added(a, b):
    return b if a is None else a if b is None else a + b


class Island:
    """The kept sessions of one island: ``[start, end, cnt, total, fired, shown]``."""

    def __init__(self, gap: int, lateness: int, emit):
        self.gap, self.lateness, self.emit, self.kept = gap, lateness, emit, []

    def fire(self, session, cause):
        for old in session[5]:
            self.emit(old, -1, cause)
        now = tuple(session[:4])
        self.emit(now, 1, cause)
        session[4], session[5] = True, [now]

    def advance(self, wm):
        """Sessions that the watermark has reached fire, those it has passed are closed."""
        if wm is None:
            return
        for s in sorted(self.kept):
            if not s[4] and s[1] - 1 <= wm:
                self.fire(s, None)
        self.kept = [s for s in self.kept if s[1] - 1 + self.lateness > wm]

    def flush(self):
        for s in sorted(self.kept):
            if not s[4]:
                self.fire(s, None)

    def add(self, lo, hi, cnt, total, wm, cause):
        self.advance(wm)
        end = hi + self.gap
        near = [s for s in self.kept if s[0] <= end and lo <= s[1]]
        if not near and wm is not None and end - 1 + self.lateness <= wm:
            return
        new = [lo, end, cnt, total, False, []]
        for s in near:
            new = [min(new[0], s[0]), max(new[1], s[1]), new[2] + s[2], added(new[3], s[3]), False, new[5] + s[5]]
        self.kept = [s for s in self.kept if not any(s is x for x in near)] + [new]
        if wm is not None and new[1] - 1 <= wm:
            self.fire(new, cause)


def result_schema(recs: DataFrame) -> T.StructType:
    key, order = recs.schema["key"].dataType, recs.schema["at"].dataType
    out = T.StructType.fromDDL(f"lo bigint, hi bigint, cnt bigint, total bigint, change int, done boolean, shown {SHOWN}").fields
    return T.StructType([T.StructField("key", key), *out[:5], T.StructField("cause", order.fields[-1].dataType), *out[5:]])


def replay(recs: DataFrame, gap_ms: int, lateness_ms: int, last_wm: int | None = None, flush: bool = True) -> DataFrame:
    """Changelog rows (change 1 or -1) and, unless ``flush``, the sessions still
    kept when the watermark is ``last_wm`` (change 0, with ``done`` and ``shown``)."""
    schema = result_schema(recs)
    arrow = to_arrow_schema(schema)

    def run(batches):
        out, name, island = [], None, None

        def emit(result, change, cause):
            out.append((name[0], result[0], result[1] - gap_ms, *result[2:4], change, cause, None, None))

        def close():
            if flush:
                island.flush()
                return
            island.advance(last_wm)
            for s, e, cnt, total, done, shown in island.kept:
                out.append((name[0], s, e - gap_ms, cnt, total, 0, None, done,
                            [dict(zip(("s", "e", "cnt", "total"), x)) for x in shown]))

        def batch():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist()
                    for c in ("key", "island", "lo", "hi", "cnt", "total", "wm", "cause", "done", "shown")]
            for k, i, lo, hi, cnt, total, wm, cause, done, shown in zip(*cols):
                if island is None or name != (k, i):
                    if island is not None:
                        close()
                    name, island = (k, i), Island(gap_ms, lateness_ms, emit)
                if shown is None:
                    island.add(lo, hi, cnt, total, wm, cause)
                else:                                   # kept from an earlier batch
                    island.kept.append([lo, hi + gap_ms, cnt, total, done,
                                        [(x["s"], x["e"], x["cnt"], x["total"]) for x in shown]])
                if len(out) >= 10_000:
                    yield batch()
        if island is not None:
            close()
        if out:
            yield batch()

    together = islands(recs, gap_ms).repartition("key", "island").sortWithinPartitions("key", "island", F.col("at").asc_nulls_first())
    cause = F.col("at")[recs.schema["at"].dataType.names[-1]].alias("cause")
    return together.select("key", "island", "lo", "hi", "cnt", "total", "wm", cause, "done", "shown").mapInArrow(run, schema)


def kept(replayed: DataFrame, recs: DataFrame, gap_ms: int) -> DataFrame:
    """The sessions that a replay without ``flush`` kept, as records for the next one."""
    return replayed.where("change = 0").select(
        "key", chunk_of("lo", gap_ms).alias("_b"), "lo", "hi", "cnt", "total", F.lit(None).cast("bigint").alias("wm"),
        F.lit(None).cast(recs.schema["at"].dataType).alias("at"), "done", "shown")


def changes(replayed: DataFrame, gap_ms: int, key: str = "id", value: str = "vc") -> DataFrame:
    return replayed.where("change != 0").select(
        F.col("key").alias(key), F.col("lo").alias("s_start"), (F.col("hi") + gap_ms).alias("s_end"), "cnt",
        F.col("total").alias(f"sum_{value}"), "change", "cause")


def session_changelog(df: DataFrame, gap_ms: int, delay_ms: int, lateness_ms: int, key: str = "id", time: str = "ts_ms",
                      value: str = "vc", arrival: tuple[str, ...] = ("arr_ms", "arrival"),
                      chunk_width: int | None = None) -> DataFrame:
    """(key, s_start, s_end, cnt, sum, change, cause); the end of the input
    fires what is left."""
    if gap_ms <= 0:
        raise ValueError("gap_ms must be positive")
    traced = watermark_trace(df, delay_ms, time, arrival, chunk_width, keep=[key, time, value, *arrival])
    recs = records(traced, gap_ms, key, time, value, arrival, chunk_for(df, arrival[0], chunk_width))
    return changes(replay(recs, gap_ms, lateness_ms), gap_ms, key, value)


def final_sessions(changelog: DataFrame, key: str = "id", value: str = "vc") -> DataFrame:
    """What the changelog leaves: results that were shown and not taken back."""
    return (changelog.groupBy(key, "s_start", "s_end", "cnt", f"sum_{value}").agg(F.sum("change").alias("n"))
                     .where("n > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n"))
