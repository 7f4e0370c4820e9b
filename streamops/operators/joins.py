"""Inner joins of two keyed inputs (J1-J4).

All pair-producing joins are equi-joins on the key (plus a time bucket where
there is a time range), so Spark plans them as sort-merge or hash joins and
AQE splits a skewed key's partition.  The output size is the semantics of the
operator: every matching pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamops.operators.windows import assign_tumbling
from streamops.plans.scan import Agg, chunk_for, floor_div, prefix_scan


def _side(df, prefix, key, cols):
    return df.select(F.col(key), *[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def window_join(left: DataFrame, right: DataFrame, size_ms: int, key: str = "id",
                time: str = "ts_ms", lcols=("arrival", "ts_ms"), rcols=("arrival", "ts_ms", "vc")) -> DataFrame:
    """Pairs with equal key in the same tumbling window: equi-join on
    (key, window start)."""
    l = assign_tumbling(left, size_ms, time).select(key, "w_start", "w_end",
                                                     *[F.col(c).alias(f"l_{c}") for c in lcols])
    r = assign_tumbling(right, size_ms, time).select(key, "w_start",
                                                      *[F.col(c).alias(f"r_{c}") for c in rcols])
    return l.join(r, [key, "w_start"]).select(key, "w_start", "w_end",
                                              *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols])


def interval_join(left: DataFrame, right: DataFrame, lower_ms: int, upper_ms: int,
                  key: str = "id", time: str = "ts_ms",
                  lcols=("arrival", "ts_ms"), rcols=("arrival", "ts_ms", "vc")) -> DataFrame:
    """Pairs with equal key and ``l.t + lower <= r.t <= l.t + upper`` (both
    ends inclusive), planned as an equi-join on the key with a range filter.

    A hot key's rows are all compared with each other in one join partition;
    at scale use ``interval_join_bucketed`` (same pairs).  This form is kept as
    its independent check."""
    l = _side(left, "l", key, lcols)
    r = _side(right, "r", key, rcols).withColumnRenamed(key, "_rk")
    cond = ((l[key] == r["_rk"]) &
            (r[f"r_{time}"] >= l[f"l_{time}"] + F.lit(lower_ms)) &
            (r[f"r_{time}"] <= l[f"l_{time}"] + F.lit(upper_ms)))
    return l.join(r, cond).select(key, *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols])


def interval_join_bucketed(left: DataFrame, right: DataFrame, lower_ms: int, upper_ms: int,
                           key: str = "id", time: str = "ts_ms",
                           lcols=("arrival", "ts_ms"), rcols=("arrival", "ts_ms", "vc")) -> DataFrame:
    """Same pairs, with a time bucket in the equi-key.

    Buckets are ``span = upper - lower`` wide (at least 1 ms).  A right row sits
    in one bucket; a left row is copied to the (at most two) buckets that
    overlap ``[t + lower, t + upper]``.  Each pair is therefore found once, and
    a hot key's rows spread over many (key, bucket) join partitions.
    """
    span = max(1, upper_ms - lower_ms)
    b_lo = floor_div(f"`l_{time}` + ({int(lower_ms)})", span)
    b_hi = floor_div(f"`l_{time}` + ({int(upper_ms)})", span)
    l = _side(left, "l", key, lcols).withColumn("_b", F.explode(F.sequence(b_lo, b_hi)))
    r = (_side(right, "r", key, rcols).withColumnRenamed(key, "_rk")
         .withColumn("_rb", floor_div(f"`r_{time}`", span)))
    cond = ((l[key] == r["_rk"]) & (l["_b"] == r["_rb"]) &
            (r[f"r_{time}"] >= l[f"l_{time}"] + F.lit(lower_ms)) &
            (r[f"r_{time}"] <= l[f"l_{time}"] + F.lit(upper_ms)))
    return l.join(r, cond).select(key, *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols])


def connect_join(left: DataFrame, right: DataFrame, key: str = "id",
                 lcols=("arrival",), rcols=("arrival",)) -> DataFrame:
    """Connected keyed streams where each side caches every past row: all
    pairs with equal key, i.e. an inner equi-join."""
    l = _side(left, "l", key, lcols)
    r = _side(right, "r", key, rcols)
    return l.join(r, key).select(key, *[f"l_{c}" for c in lcols], *[f"r_{c}" for c in rcols])


def connect_join_ttl(left: DataFrame, right: DataFrame, ttl_ms: int, key: str = "id", time: str = "ts_ms",
                     lcols=("arrival", "ts_ms"), rcols=("arrival", "ts_ms")) -> DataFrame:
    """Connected keyed streams whose cached rows expire: pairs with equal key
    whose times are less than ``ttl_ms`` apart, whichever came first.  An
    interval join in its bucketed form, so the pairs of a key are bounded by
    what it receives within one expiry, and a hot key spreads over buckets."""
    return interval_join_bucketed(left, right, -(ttl_ms - 1), ttl_ms - 1, key, time, lcols, rcols)


def asof_threshold(data: DataFrame, config: DataFrame, order: str = "arrival",
                   value: str = "vc", threshold_col: str = "threshold",
                   default: int = 0, width: int | None = None,
                   keep=("id",)) -> DataFrame:
    """Broadcast-state join: each data row is compared with the latest config
    value that arrived before it (``default`` before any), and kept when its
    value is strictly above it.

    An as-of join by arrival: data and config are unioned and the last
    non-null threshold is carried along the arrival order by a chunked prefix
    scan – no range join, no nested loop, and nothing is broadcast whose size
    grows with the data.  Value and threshold keep the types of their inputs.
    """
    value_type, th_type = data.schema[value].dataType, config.schema[threshold_col].dataType
    u = (data.select(order, value, *keep, F.lit(None).cast(th_type).alias("_th"), F.lit(True).alias("_is_data"))
         .unionByName(config.select(order, F.lit(None).cast(value_type).alias(value),
                                    *[F.lit(None).cast(data.schema[k].dataType).alias(k) for k in keep],
                                    F.col(threshold_col).alias("_th"), F.lit(False).alias("_is_data"))))
    s = prefix_scan(u, [], [order], chunk_for(u, order, width), [Agg("_cur", "last_nonnull", F.col("_th"))],
                    keep=[order, value, *keep, "_is_data"])
    th = F.coalesce(F.col("_cur"), F.lit(default).cast(th_type))
    return s.where(F.col("_is_data") & (F.col(value) > th)).select(
        order, *keep, value, th.alias(threshold_col))


def _with_config(data: DataFrame, config: DataFrame, order: str, cols: list[str], name: str, value: str,
                 by: Column) -> DataFrame:
    """Data and config rows in one frame.  ``_put`` is the config row's value in
    a struct, so that a NULL value is an update too; ``_name`` is the entry that
    the row sets or asks for; of rows with one order value the config comes first."""
    put_type = config.schema[value].dataType
    rows = data.select(order, *cols, by.alias("_name"), F.lit(None).cast(f"struct<v:{put_type.simpleString()}>").alias("_put"),
                       F.lit(1).alias("_is_data"))
    sets = config.select(order, *[F.lit(None).cast(data.schema[c].dataType).alias(c) for c in cols], F.col(name).alias("_name"),
                         F.struct(F.col(value).alias("v")).alias("_put"), F.lit(0).alias("_is_data"))
    return rows.unionByName(sets)


def asof_lookup(data: DataFrame, config: DataFrame, by: str, order: str = "arrival", name: str = "name",
                value: str = "value", width: int | None = None) -> DataFrame:
    """Broadcast state as a map: config rows put ``value`` under ``name``; each
    data row gets (as column ``value``) what its entry ``by`` held when it
    arrived, NULL if nothing or a NULL was put last.

    A versioned as-of join per config key: the last put is carried along the
    arrival order of each entry by a scan over (entry, chunk).  Any number of
    entries and any type of value; an entry that a third of all data rows ask for
    is spread over its chunks; the map is never held in one place.  NULL is an
    entry like any other."""
    cols = [c for c in data.columns if c != order]
    u = _with_config(data, config, order, cols, name, value, F.col(by))
    s = prefix_scan(u, ["_name"], [order, "_is_data"], chunk_for(u, order, width),
                    [Agg("_put_last", "last_nonnull", F.col("_put"))], keep=[order, *cols, "_is_data"])
    return s.where(F.col("_is_data") == 1).select(*data.columns, F.col("_put_last.v").alias(value))


def asof_entries(data: DataFrame, config: DataFrame, names: list[str], order: str = "arrival", name: str = "name",
                 value: str = "value", width: int | None = None) -> DataFrame:
    """As ``asof_lookup`` for rows that each need the same few entries: one
    column for each of ``names``, from one scan that carries all of them."""
    cols = [c for c in data.columns if c != order]
    u = _with_config(data, config.where(F.col(name).isin(names)), order, cols, name, value, F.lit(None).cast(config.schema[name].dataType))
    aggs = [Agg(f"_put_{i}", "last_nonnull", F.when(F.col("_name") == n, F.col("_put"))) for i, n in enumerate(names)]
    s = prefix_scan(u, [], [order, "_is_data"], chunk_for(u, order, width), aggs, keep=[order, *cols, "_is_data"])
    return s.where(F.col("_is_data") == 1).select(*data.columns, *(F.col(f"_put_{i}.v").alias(n) for i, n in enumerate(names)))
