"""Keyed state, batch forms (ST1-ST7): the value each row sees or produces
when the input is replayed in arrival order.  The streaming forms with
``transformWithStateInPandas`` live in ``streamops.streaming.processors`` and
must reach the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamops.plans.scan import Agg, chunk_for, chunked, floor_div, prefix_scan


def jump_alert(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
               threshold: int = 10, width: int | None = None) -> DataFrame:
    """Rows whose value differs from the key's previous value by more than
    ``threshold``; the previous value of a key's first row is 0."""
    s = prefix_scan(df, [key], [order], chunk_for(df, order, width),
                    [Agg("_prev", "last", F.col(value), inclusive=False)], keep=[order, key, value])
    prev = F.coalesce(F.col("_prev"), F.lit(0))
    # in BIGINT: two INT values can be further apart than an INT can hold
    return s.where(F.abs(F.col(value).cast("bigint") - prev.cast("bigint")) > threshold).select(
        order, key, value, prev.alias("prev_vc"))


def value_counts_running(df: DataFrame, key: str = "id", order: str = "arrival",
                         value: str = "vc", width: int | None = None) -> DataFrame:
    """Map state ``value -> count``: per row, the count of its own value so far
    (the long form of the whole map; emitting the map per row is quadratic)."""
    s = prefix_scan(df, [key, value], [order], chunk_for(df, order, width),
                    [Agg("cnt", "count", F.lit(1))], keep=[order, key, value])
    return s.select(order, key, value, "cnt")


def value_counts_final(df: DataFrame, key: str = "id", value: str = "vc") -> DataFrame:
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("cnt"))


def map_deltas(df: DataFrame, every: int, key: str = "id", order: str = "arrival", value: str = "vc",
               width: int | None = None) -> DataFrame:
    """The map state ``value -> count`` as changes: each row's own entry after it
    (order, key, value, cnt), the row's place in its key and its segment of
    ``every`` rows.  With ``map_snapshots`` the whole map at any row can be made
    again (``map_at``), from output that grows with the input."""
    chunk = chunk_for(df, order, width)
    s = prefix_scan(df, [key], [order], chunk, [Agg("pos", "count", F.lit(1))], keep=[order, key, value])
    s = prefix_scan(s, [key, value], [order], chunk, [Agg("cnt", "count", F.lit(1))], keep=[order, key, value, "pos"])
    return s.select(order, key, value, "cnt", "pos", floor_div("`pos` - 1", every).alias("segment"))


def map_snapshots(deltas: DataFrame, every: int, key: str = "id", order: str = "arrival", value: str = "vc") -> DataFrame:
    """The whole map after every ``every`` rows of a key: (key, segment, order,
    value, cnt), one row for each entry.  An entry's count after a segment is its
    last change up to there, so changes are combined by segment map-side and each
    is repeated until the next.  Linear where ``every`` is at least the number of
    a key's entries."""
    ends = deltas.where(F.col("pos") % every == 0).select(F.col(key).alias("_key"), "segment", F.col(order))
    last = deltas.groupBy(F.col(key).alias("_key2")).agg((floor_div("max(`pos`)", every) - 1).alias("_last"))
    changes = deltas.groupBy(key, value, "segment").agg(F.max("cnt").alias("cnt"))
    following = F.lead("segment").over(Window.partitionBy(key, value).orderBy("segment"))
    changes = changes.withColumn("_next", following).join(last, F.col(key).eqNullSafe(F.col("_key2")))
    upto = F.least(F.coalesce(F.col("_next") - 1, F.col("_last")), F.col("_last"))
    filled = changes.where(F.col("segment") <= upto).select(key, value, "cnt", F.explode(F.sequence("segment", upto)).alias("_s"))
    return filled.join(ends, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_s") == F.col("segment"))).select(
        key, "segment", order, value, "cnt")


def map_at(deltas: DataFrame, snapshots: DataFrame, of: str | None, at: int, key: str = "id", order: str = "arrival",
           value: str = "vc") -> DataFrame:
    """(value, cnt): the map of key ``of`` after the row ``at``: the last
    snapshot and the changes after it."""
    mine = snapshots.where(F.col(key).eqNullSafe(F.lit(of)) & (F.col(order) <= at))
    top = mine.agg(F.max("segment").alias("s")).scalar()
    base = mine.where(F.col("segment") == top).select(value, "cnt")
    since = deltas.where(F.col(key).eqNullSafe(F.lit(of)) & (F.col(order) <= at)
                         & (F.col("segment") > F.coalesce(top, F.lit(-1)))).select(value, "cnt")
    return base.unionByName(since).groupBy(value).agg(F.max("cnt").alias("cnt"))


def running_sum(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                width: int | None = None) -> DataFrame:
    s = prefix_scan(df, [key], [order], chunk_for(df, order, width),
                    [Agg("sum_vc", "sum", F.col(value).cast("bigint"))], keep=[order, key, value])
    return s.select(order, key, value, "sum_vc")


def running_avg(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                width: int | None = None) -> DataFrame:
    """Running mean from an exact BIGINT sum and a count."""
    s = prefix_scan(df, [key], [order], chunk_for(df, order, width),
                    [Agg("_s", "sum", F.col(value).cast("bigint")), Agg("_n", "count", F.col(value))],
                    keep=[order, key, value])
    return s.select(order, key, value, (F.col("_s").cast("double") / F.col("_n")).alias("avg_vc"))


def ttl_state(df: DataFrame, ttl_ms: int, key: str = "id", order: str = "arrival",
              time: str = "ts_ms", value: str = "vc", write_above: int = 10,
              width: int | None = None) -> DataFrame:
    """Value state with a TTL refreshed on every read and write.

    Each row reads the state (and so refreshes it), emits the old value, and
    writes its own value when it is above ``write_above``.  A state expires
    when the key is idle for ``ttl_ms`` or more; an expired value is never
    returned.  So the value a row sees is the last written value among the
    earlier rows of its *island* (rows of a key with gaps < ttl).
    """
    chunk = chunk_for(df, order, width)
    s = prefix_scan(df, [key], [order], chunk, [Agg("_pt", "last", F.col(time), inclusive=False)],
                    keep=[order, key, time, value])
    brk = F.col("_pt").isNull() | (F.col(time) - F.col("_pt") >= ttl_ms)
    # one more scan carries both the start of the current island and the
    # last write before this row; a write from an earlier island is expired
    # (the last write's arrival and value share one non-null mask, so they
    # always come from the same row; primitive columns keep hash aggregates)
    wrote = F.col(value) > write_above
    s = prefix_scan(s, [key], [order], chunk,
                    [Agg("_start", "last_nonnull", F.when(brk, F.col(order))),
                     Agg("_wo", "last_nonnull", F.when(wrote, F.col(order)), inclusive=False),
                     Agg("_wv", "last_nonnull", F.when(wrote, F.col(value)), inclusive=False)],
                    keep=[order, key, time, value])
    s = s.withColumn("state", F.when(F.col("_wo") >= F.col("_start"), F.col("_wv")))
    return s.select(order, key, time, value, "state")


def bucket_running_count(df: DataFrame, n: int, order: str = "arrival",
                         width: int | None = None) -> DataFrame:
    """Operator list state: a running element count per fixed bucket (the
    stand-in for a subtask), ``bucket = pmod(arrival, n)``."""
    d = df.withColumn("bucket", F.pmod(F.col(order), F.lit(n)).cast("int"))
    s = prefix_scan(d, ["bucket"], [order], chunk_for(df, order, width), [Agg("cnt", "count", F.lit(1))],
                    keep=[order, "bucket"])
    return s.select(order, "bucket", "cnt")


# --- running top-k values (list state) -------------------------------------

def _levels(df: DataFrame, value: str, k: int, w) -> DataFrame:
    """Adds ``_t1.._tk``: the k largest values of the window up to each row.

    The largest value is a running max.  What a row displaces there, the lesser
    of its value and the previous largest, is the input of the second level,
    and so on; all levels share one partition and sort."""
    x = value
    for i in range(1, k + 1):
        df = df.withColumn(f"_t{i}", F.max(x).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        if i < k:
            before = F.max(x).over(w.rowsBetween(Window.unboundedPreceding, -1))
            df = df.withColumn(f"_p{i}", before)
            low = F.when(F.col(x).isNotNull() & F.col(f"_p{i}").isNotNull(), F.least(F.col(x), F.col(f"_p{i}")))
            df = df.withColumn(f"_d{i}", low)
            x = f"_d{i}"
    return df


def running_top_k(df: DataFrame, k: int = 3, key: str = "id", order: str = "arrival",
                  value: str = "vc", width: int | None = None) -> DataFrame:
    """After each row, the ``k`` largest values of its key so far, descending,
    as columns ``top1..topk`` (NULL while fewer exist), in the value's type.

    1. per (key, chunk) the running k largest; a chunk's last row has its total;
    2. per key the same over the chunks' totals (at most k rows for each), so
       that every chunk sees the k largest of all earlier ones;
    3. each row's k largest, merged with this carry.
    All of it is built-in windows and sorts of k-element arrays, over one
    exchange of the rows and one of the chunk table.  A NULL value changes
    nothing; NULL is a key like any other."""
    ch = chunked(df, [key], [order], chunk_for(df, order, width), [], [order, key, value])
    tops = F.array(*(F.col(f"_t{i + 1}") for i in range(k)))
    rows = _levels(ch.rows, value, k, ch.window)
    ends = rows.withColumn("_more", F.lead(F.lit(1)).over(ch.window)).where(F.col("_more").isNull())
    each = ends.select(*ch.pcols, F.posexplode(tops).alias("_r", "_v"))
    by_key = Window.partitionBy(*ch.pcols[1:])
    states = _levels(each, "_v", k, by_key.orderBy("_chunk", "_r")).groupBy(*ch.pcols).agg(F.max_by(tops, "_r").alias("_state"))
    carry = states.select(*ch.names(), F.lag("_state").over(by_key.orderBy("_chunk")).alias("_carry"))
    j = ch.with_carry(rows, carry)
    none = F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")
    both = F.concat(tops, F.coalesce("_carry", none))
    j = j.withColumn("_top", F.sort_array(F.filter(both, lambda v: v.isNotNull()), asc=False))
    return j.select(*ch.kept, *(F.get("_top", F.lit(i)).alias(f"top{i + 1}") for i in range(k))).select(
        order, key, value, *(f"top{i + 1}" for i in range(k)))
