"""Top-N values by frequency per sliding window (N1, N2).

Ties in count are broken by the smaller value ([decision]); fewer than N
values give fewer rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamops.operators.windows import assign_sliding, panes


def _counts(df, size_ms, slide_ms, time, value):
    p = panes(df, size_ms, slide_ms, [value], [F.count(F.lit(1)).alias("_c")], time)
    return assign_sliding(p, size_ms, slide_ms, "_pane").groupBy("w_start", "w_end", value).agg(
        F.sum("_c").cast("bigint").alias("cnt"))


def topn_all_window(df: DataFrame, n: int, size_ms: int, slide_ms: int,
                    time: str = "ts_ms", value: str = "vc") -> DataFrame:
    """Non-keyed: count per (window, value) with partial aggregation, then a
    rank window partitioned by the window."""
    c = _counts(df, size_ms, slide_ms, time, value)
    w = Window.partitionBy("w_start").orderBy(F.col("cnt").desc(), F.col(value).asc())
    return (c.withColumn("rank", F.row_number().over(w).cast("bigint"))
             .where(F.col("rank") <= n).select("w_start", "w_end", "rank", value, "cnt"))


def topn_keyed(df: DataFrame, n: int, size_ms: int, slide_ms: int,
               time: str = "ts_ms", value: str = "vc", shards: int = 64) -> DataFrame:
    """Two stages as in the keyed form: (1) keyed by value, a sliding-window
    count; (2) keyed by window, the top ``n``.

    Stage 2 is a two-level top-N: first the top ``n`` inside each
    (window, hash shard of the value) – a rank window bounded by one shard's
    values – then a merge of at most ``shards * n`` candidates per window,
    collected and sorted.  One pass over the input, and no collection grows
    with the data.
    """
    c = _counts(df, size_ms, slide_ms, time, value)
    w1 = Window.partitionBy("w_start", "_shard").orderBy(F.col("cnt").desc(), F.col(value).asc())
    cand = (c.withColumn("_shard", F.pmod(F.hash(F.col(value)), F.lit(shards)))
             .withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n))
    best = cand.groupBy("w_start", "w_end").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("cnt")).alias("nc"), F.col(value).alias("v")))), 1, n).alias("top"))
    return best.select("w_start", "w_end", F.posexplode("top").alias("p", "e")).select(
        "w_start", "w_end", (F.col("p") + 1).cast("bigint").alias("rank"),
        F.col("e.v").alias(value), (-F.col("e.nc")).alias("cnt"))


def pruned_candidates(df: DataFrame, n: int, size_ms: int, slide_ms: int, time: str = "ts_ms", value: str = "vc",
                      items: int = 1000) -> DataFrame:
    """(w_start, w_end, rank, value, cnt, proven): the exact ``n`` most frequent
    of each window's candidates, and whether they are proven to be the window's.

    A frequent-items sketch for each pane is combined to the windows (map-side
    combined, ``items`` counters, whatever the number of values).  Its candidates
    are counted exactly: rows of other values drop out before the count, so that
    the shuffle and the ranking see at most ``items`` values a window.  A value
    that is no candidate occurs at most ``3.5 / items`` of the window's rows, the
    error bound of the sketch; ranks above that are right."""
    pane = math.gcd(size_ms, slide_ms)
    t = F.col(time)
    rows = df.select((t - F.pmod(t, F.lit(pane))).alias("_pane"), F.col(value).alias("_v"))
    per = rows.groupBy("_pane").agg(F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k_accumulate(_v, {int(items)})").alias("_s"))
    per = assign_sliding(per, size_ms, slide_ms, "_pane").groupBy("w_start", "w_end").agg(
        F.sum("_n").alias("_n"), F.expr(f"approx_top_k_combine(_s, {int(items)})").alias("_s"))
    found = F.expr(f"array_union(transform(approx_top_k_estimate(_s, {int(items)}), e -> e.item), array(NULL))")
    cand = per.select("w_start", "w_end", (F.col("_n") * 3.5 / items).alias("_bound"), F.explode(found).alias("_c"))
    in_panes = cand.select(F.explode(F.sequence("w_start", F.col("w_end") - 1, F.lit(pane))).alias("_pane"), "_c").distinct()
    a, b = rows.alias("a"), in_panes.alias("b")
    counts = a.join(b, (F.col("a._pane") == F.col("b._pane")) & F.col("a._v").eqNullSafe(F.col("b._c")), "left_semi").groupBy(
        "_pane", "_v").agg(F.count(F.lit(1)).alias("_c0"))
    counts = assign_sliding(counts, size_ms, slide_ms, "_pane").groupBy(F.col("w_start").alias("_w"), "_v").agg(
        F.sum("_c0").cast("bigint").alias("cnt"))
    mine = cand.join(counts, (F.col("w_start") == F.col("_w")) & F.col("_c").eqNullSafe(F.col("_v")))
    w = Window.partitionBy("w_start").orderBy(F.col("cnt").desc(), F.col("_v").asc())
    top = mine.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)
    whole = Window.partitionBy("w_start")
    enough = (F.max("rank").over(whole) == n) & (F.min("cnt").over(whole) > F.col("_bound"))
    return top.select("w_start", "w_end", "rank", F.col("_v").alias(value), "cnt", ((F.col("_bound") < 1) | enough).alias("proven"))


def topn_pruned(df: DataFrame, n: int, size_ms: int, slide_ms: int, time: str = "ts_ms", value: str = "vc",
                items: int = 1000) -> DataFrame:
    """The rows of ``topn_all_window`` where windows hold very many values: the
    ranked candidates of a sketch where they are proven, the exact count of all
    values in the windows where they are not."""
    top = pruned_candidates(df, n, size_ms, slide_ms, time, value, items)
    cols = ["w_start", "w_end", "rank", value, "cnt"]
    unsure = top.where(~F.col("proven")).select(F.col("w_start").alias("_w"), F.col("w_end").alias("_e")).distinct()
    pane = math.gcd(size_ms, slide_ms)
    unsure_panes = unsure.select(F.explode(F.sequence("_w", F.col("_e") - 1, F.lit(pane))).alias("_pane")).distinct()
    t = F.col(time)
    some = df.withColumn("_p", t - F.pmod(t, F.lit(pane)))
    some = some.join(unsure_panes, some["_p"] == unsure_panes["_pane"], "left_semi").drop("_p")
    exact = topn_all_window(some, n, size_ms, slide_ms, time, value)
    exact = exact.join(unsure, exact["w_start"] == unsure["_w"], "left_semi")
    return top.where("proven").select(*cols).unionByName(exact.select(*cols))
