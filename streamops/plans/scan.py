"""Chunked prefix scan: running aggregates in a fixed order, skew-safe.

``Window.partitionBy(key).orderBy(arrival)`` puts every row of a key into
one task; a key holding a third of the data would then be sorted and
scanned by a single core.  The scan below splits each key's order range
into chunks (``chunk`` must be non-decreasing along the order):

1. per (key, chunk): the chunk's total, by a partial + final hash aggregate;
2. per key: the carry = total of all earlier chunks, a window over the
   chunk table: one row per non-empty chunk, at most ``MAX_CHUNKS`` per key
   where the chunks come from ``density_chunk``;
3. per (key, chunk): the running value inside the chunk, combined with the
   carry.  The rows are joined to the carry on (key, chunk) – AQE turns this
   into a broadcast join when the chunk table is small at run time – and the
   inner window is partitioned by (key, chunk), so no task ever holds more
   than one chunk of one key.

The order columns must be unique within a key for ``first``/``last`` to be
deterministic (every caller passes the arrival column).
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("sum", "count", "max", "min", "first", "last", "last_nonnull")


@dataclass(frozen=True)
class Agg:
    """One running aggregate.

    kind       one of KINDS
    expr       the input column
    inclusive  True: rows up to and including the current row;
               False: only rows strictly before it (a ``lag``-style frame)
    """

    name: str
    kind: str
    expr: Column
    inclusive: bool = True

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown scan kind {self.kind!r}")


def _default(t: T.DataType) -> Column:
    """A non-null placeholder of type ``t`` (only used next to an is-null flag)."""
    if isinstance(t, T.StringType):
        return F.lit("")
    if isinstance(t, T.BooleanType):
        return F.lit(False)
    if isinstance(t, (T.NumericType,)):
        return F.lit(0).cast(t)
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast("timestamp").cast(t)
    if isinstance(t, T.BinaryType):
        return F.lit(b"").cast(t)
    raise TypeError(f"unsupported scan key type {t.simpleString()}")


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


@dataclass(frozen=True)
class Chunked:
    """Rows shuffled by (chunk, key), with the plan's helper columns.

    pcols   the chunk and the key in null-safe form: ``_chunk, _k0, _n0, ...``;
            before them ``_h``, a hash of them, where sorts go by it first
    order   the order columns
    kept    the columns to keep, made of those of ``rows``
    window  by chunk and key, in order"""

    rows: DataFrame
    pcols: list[str]
    order: list[Column]
    kept: list[Column]

    @property
    def window(self):
        return Window.partitionBy(*self.pcols).orderBy(*self.order)

    def totals(self, *aggs: Column) -> DataFrame:
        """One row for each (chunk, key).  Its rows read every column of the
        exchange (the hash in the condition, which is never null), so that Spark
        finds this exchange and that of ``rows`` equal and runs it once."""
        alike = F.bit_xor(F.hash(*self.rows.columns)).alias("_alike")
        return self.rows.groupBy(*self.pcols).agg(*aggs, alike).where(F.col("_alike").isNotNull()).drop("_alike")

    def earlier(self):
        """Window over the totals of a key's earlier chunks."""
        key = [c for c in self.pcols if c not in ("_h", "_chunk")]
        return Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def with_carry(self, rows: DataFrame, carry: DataFrame, how: str = "inner") -> DataFrame:
        """``rows`` beside their chunk's row of ``carry``, whose helper columns
        are ``_c`` and the name."""
        cond = None
        for c in self.pcols:
            e = rows[c] == carry[f"_c{c}"]
            cond = e if cond is None else cond & e
        return rows.join(carry, cond, how)

    def names(self) -> list[Column]:
        return [F.col(c).alias(f"_c{c}") for c in self.pcols]


def chunked(df: DataFrame, partition_by: list[str], order_by: list[str], chunk: Column, extra: list[Column],
            keep: list[str], by_hash: bool = False) -> Chunked:
    """The columns ``keep`` and ``extra`` of ``df``, shuffled by (chunk, key).

    ``by_hash`` sorts by a hash of them first: a sort compares the first column
    without reading the rows, and one chunk has many keys where they are words."""
    # Plain, null-safe surrogate key columns: coalesce(k, default) plus an
    # is-null flag for nullable keys.  Plain atomic columns keep sort prefixes
    # and hash partitioning cheap, and an inner equi-join on them keeps NULL
    # keys (which a join on the raw key would drop).  All helper columns are
    # added in one projection (one analysis pass).
    # A NULL order value sorts first (ASC NULLS FIRST), so its row belongs to
    # the lowest chunk: a NULL chunk becomes the smallest BIGINT instead of
    # being lost in the equi-join.
    # A kept key is not shuffled beside its surrogate but made of it afterwards.
    pcols, cols = ["_chunk"], [F.coalesce(chunk, F.lit(-(1 << 63)).cast("bigint")).alias("_chunk")]
    schema, out = df.schema, {c: F.col(c) for c in keep}
    for i, k in enumerate(partition_by):
        f = schema[k]
        cols.append(F.coalesce(F.col(k), _default(f.dataType)).alias(f"_k{i}"))
        pcols.append(f"_k{i}")
        whole = F.col(f"_k{i}")
        if f.nullable:
            cols.append(F.col(k).isNull().alias(f"_n{i}"))
            pcols.append(f"_n{i}")
            whole = F.when(~F.col(f"_n{i}"), whole)
        if k in out and k not in order_by:
            out[k] = whole.alias(k)
    raw = [c for c in keep if c not in partition_by or c in order_by]
    cols += [F.col(o) for o in order_by if isinstance(o, str) and o not in keep]
    rows = df.select(*raw, *cols, *extra)
    if by_hash:
        rows, pcols = rows.withColumn("_h", F.hash(*pcols)), ["_h", *pcols]
    return Chunked(rows.repartition(*pcols), pcols, _cols(order_by), list(out.values()))


def prefix_scan(df: DataFrame, partition_by: list[str], order_by: list[str],
                chunk: Column, aggs: list[Agg], reuse_input: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Append one column per ``Agg`` holding its running value.

    partition_by  key columns (may be empty: one global order)
    order_by      order columns, unique within a key
    chunk         BIGINT expression, non-decreasing along ``order_by``
    keep          columns of ``df`` in the result (default: all); the fewer, the
                  less is shuffled
    reuse_input   where the chunk totals come from.  False: an aggregate of the
                  shuffled rows.  True: the last running value of each chunk, for
                  keys so many that (chunk, key) groups are few rows each (words).
    """
    names = {a.name for a in aggs}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names or c in partition_by + list(order_by)]
    # an expression that several aggregates share (one Column object) is shuffled once
    at = {id(a.expr): i for i, a in reversed(list(enumerate(aggs)))}
    xs = [F.col(f"_x{at[id(a.expr)]}") for a in aggs]
    ch = chunked(df, partition_by, order_by, chunk, [aggs[i].expr.alias(f"_x{i}") for i in sorted(at.values())], keep)
    pcols, ordc, d, wc = ch.pcols, ch.order, ch.rows, ch.window
    incl = wc.rowsBetween(Window.unboundedPreceding, 0)
    excl = wc.rowsBetween(Window.unboundedPreceding, -1)

    # running values inside the chunk
    within = [F.count(F.lit(1)).over(excl).alias("_nin")]
    for i, a in enumerate(aggs):
        x = xs[i]
        fr = incl if a.inclusive else excl
        if a.kind == "sum":
            w = F.sum(x).over(fr)
        elif a.kind == "count":
            w = F.count(x).over(fr)
        elif a.kind == "max":
            w = F.max(x).over(fr)
        elif a.kind == "min":
            w = F.min(x).over(fr)
        elif a.kind == "first":
            w = F.first(x).over(fr)
        elif a.kind == "last":
            w = x if a.inclusive else F.last(x).over(fr)
        else:
            w = F.last(x, ignorenulls=True).over(fr)
        within.append(w.alias(f"_w{i}"))

    # 1. chunk totals
    if reuse_input:
        whole = wc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        tot = [F.count(F.lit(1)).over(whole).alias("_n")]
        for i, a in enumerate(aggs):
            x = xs[i]
            t = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min,
                 "first": F.first, "last": F.last}.get(a.kind)
            t = t(x).over(whole) if t else F.last(x, ignorenulls=True).over(whole)
            tot.append(t.alias(f"_t{i}"))
        rows = d.select("*", *within, *tot, F.row_number().over(wc).alias("_rn"))
        chunks = rows.where(F.col("_rn") == 1).select(*pcols, "_n", *[f"_t{i}" for i in range(len(aggs))])
    else:
        # a single order column orders min_by/max_by directly: primitive buffers
        # keep the totals in a hash aggregate (a struct forces a sort-based one)
        ord_struct = ordc[0] if len(ordc) == 1 else F.struct(*ordc)
        tot = [F.count(F.lit(1)).alias("_n")]
        for i, a in enumerate(aggs):
            x = xs[i]
            if a.kind == "sum":
                t = F.sum(x)
            elif a.kind == "count":
                t = F.count(x)
            elif a.kind == "max":
                t = F.max(x)
            elif a.kind == "min":
                t = F.min(x)
            elif a.kind == "first":
                t = F.min_by(x, ord_struct)
            elif a.kind == "last":
                t = F.max_by(x, ord_struct)
            else:  # last_nonnull
                t = F.max_by(x, F.when(x.isNotNull(), ord_struct))
            tot.append(t.alias(f"_t{i}"))
        chunks = ch.totals(*tot)
        rows = d.select("*", *within)

    # 2. carry over earlier chunks of the same key
    wk = ch.earlier()
    carry = [*ch.names(), F.sum("_n").over(wk).alias("_cn")]
    for i, a in enumerate(aggs):
        t = F.col(f"_t{i}")
        if a.kind in ("sum", "count"):
            c = F.sum(t).over(wk)
        elif a.kind == "max":
            c = F.max(t).over(wk)
        elif a.kind == "min":
            c = F.min(t).over(wk)
        elif a.kind == "first":
            c = F.first(t).over(wk)
        elif a.kind == "last":
            c = F.last(t).over(wk)
        else:
            c = F.last(t, ignorenulls=True).over(wk)
        carry.append(c.alias(f"_c{i}"))

    # 3. the in-chunk window runs first (rows shuffled by (chunk, key)); the
    # join to the carry then reuses that partitioning, or probes a broadcast
    # carry in the parallel post-shuffle tasks
    j = ch.with_carry(rows, chunks.select(*carry))
    outs = []
    for i, a in enumerate(aggs):
        w, c, n_in = F.col(f"_w{i}"), F.col(f"_c{i}"), F.col("_nin")
        if a.kind == "sum":
            v = F.coalesce(w + c, w, c)
        elif a.kind == "count":
            v = F.coalesce(w, F.lit(0)) + F.coalesce(c, F.lit(0))
        elif a.kind == "max":
            v = F.greatest(w, c)
        elif a.kind == "min":
            v = F.least(w, c)
        elif a.kind == "first":
            has_before = F.coalesce(F.col("_cn"), F.lit(0)) > 0
            v = F.when(has_before, c).otherwise(w) if a.inclusive else \
                F.when(has_before, c).when(n_in > 0, w)
        elif a.kind == "last":
            v = w if a.inclusive else F.when(n_in > 0, w).otherwise(c)
        else:
            v = F.coalesce(w, c)
        outs.append(v.alias(a.name))
    # the kept columns (minus any an aggregate replaces) plus the results
    return j.select(*[c for c, name in zip(ch.kept, keep) if name not in names], *outs)


def halo_scan(df: DataFrame, partition_by: list[str], order_by: list[str], chunk: Column, value: Column, size: int,
              within: dict[str, Column], keep: list[str]) -> DataFrame:
    """Frames of a row and the ``size - 1`` rows before it, across chunks.

    Adds ``_pos`` (the row's place in its key, from 1), ``_halo`` (the values of
    the frame's rows that lie in earlier chunks, in order) and the aggregates
    ``within`` (of ``_v``, the value) over its rows in the own chunk.

    A chunk's summary is its number of rows and its last ``size - 1`` values;
    the halo of a chunk is the end of the summaries before it joined, of which
    ``size - 1`` are enough as none is empty.  So any frame is evaluated as it
    is, and no row is joined to another by its place."""
    if size < 1:
        raise ValueError("size must be positive")
    ch = chunked(df, partition_by, order_by, chunk, [value.alias("_v")], keep)
    back = size - 1
    last = ch.rows.select("*", F.lead(F.lit(1), max(1, back)).over(ch.window).alias("_more"),
                          F.row_number().over(ch.window).cast("bigint").alias("_r"))
    # the rows that no row follows ``back`` rows on are the chunk's end; values in structs, so that NULLs stay
    end = last.where(F.col("_more").isNull()).groupBy(*ch.pcols).agg(
        F.max("_r").alias("_n"), F.array_sort(F.collect_list(F.struct("_r", "_v"))).alias("_end"))
    before = ch.earlier()
    joined = F.flatten(F.collect_list(F.col("_end._v")).over(before.rowsBetween(-max(1, back), -1)))
    carry = end.select(*ch.names(), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_cn"),
                       F.slice(joined, F.greatest(F.size(joined) - back + 1, F.lit(1)), back).alias("_whole"))
    here = ch.window.rowsBetween(-back, 0)
    rows = ch.rows.select("*", F.row_number().over(ch.window).cast("bigint").alias("_r"),
                          *[a.over(here).alias(n) for n, a in within.items()])
    j = ch.with_carry(rows, carry)
    lacking = F.least(F.greatest(F.lit(size) - F.col("_r"), F.lit(0)).cast("int"), F.size("_whole"))
    return j.select(*ch.kept, (F.col("_cn") + F.col("_r")).alias("_pos"), *within,
                    F.slice("_whole", F.size("_whole") - lacking + 1, lacking).alias("_halo"))


def floor_div(sql: str, n: int) -> Column:
    """Exact integer floor division of a BIGINT SQL expression by ``n``."""
    return F.expr(f"(({sql}) - pmod(({sql}), {int(n)})) div {int(n)}")


def chunk_of(col: str, width: int) -> Column:
    """Fixed-width chunk number of a BIGINT order column (floor division)."""
    return floor_div(f"`{col}`", width)


# Chunk numbers from row density.  A task holds at most one chunk of one key.
#: Rows of one chunk, all keys together, at most (in expectation).
TARGET_ROWS = 4_000_000
#: At least this many chunks, so that a hot key of a small input uses all cores.
MIN_CHUNKS = 16
#: At most this many: the carry window of a key (or of a scan without key) runs
#: over one row for each chunk, so this is its bound; above it chunks grow.
MAX_CHUNKS = 1 << 18
#: Quantiles of the order column that the chunk boundaries follow.
SEGMENTS = 64
#: Fixed width of time chunks (ms) where the key holds the window's start, so
#: that a key spans few chunks.
TIME_CHUNK_MS = 60_000


def chunk_edges(n: int, edges: list[int], target_rows: int = TARGET_ROWS,
                min_chunks: int = MIN_CHUNKS) -> list[tuple[int, int, int]]:
    """(start, first chunk, width) of each segment between ``edges`` (ascending
    quantiles with both ends) for ``n`` rows."""
    chunks = min(MAX_CHUNKS, max(min_chunks, -(-n // target_rows)))
    parts = -(-chunks // max(1, len(edges) - 1))
    return [(a, i * parts, max(1, -(-(b - a) // parts))) for i, (a, b) in enumerate(zip(edges, edges[1:]))]


#: Sketches of this process: an order column is looked at once for each state of its table.
_SKETCHES: OrderedDict[tuple, tuple] = OrderedDict()
KEPT_SKETCHES = 256
#: Size of the sketch: a quantile is off by about 0.1% of the rows.
SKETCH_K = 2000


def order_sketch(df: DataFrame, order_col: str) -> tuple[int, int | None, int | None, list[int]]:
    """(rows, least, greatest, ``SEGMENTS`` + 1 quantiles) of an order column.

    A KLL sketch, combined map-side, one row to the driver.  It is kept by the
    plan and size of ``df``; where a table grew without being noticed, chunks are
    larger or more than meant, and results the same."""
    query = df._jdf.queryExecution()
    state = (df.sparkSession.sparkContext.applicationId, df.semanticHash(),
             str(query.optimizedPlan().stats().sizeInBytes()), order_col)
    if state not in _SKETCHES:
        c = F.col(order_col).cast("bigint")
        steps = F.array(*(F.lit(k / SEGMENTS) for k in range(SEGMENTS + 1)))
        one = df.agg(F.count(c).alias("n"), F.min(c).alias("a"), F.max(c).alias("b"),
                     F.kll_sketch_agg_bigint(c, F.lit(SKETCH_K)).alias("s"))
        r = one.select("n", "a", "b", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("s", steps)).alias("q")).first()
        _SKETCHES[state] = (r["n"], r["a"], r["b"], list(r["q"] or []))
        while len(_SKETCHES) > KEPT_SKETCHES:
            _SKETCHES.popitem(last=False)
    _SKETCHES.move_to_end(state)
    return _SKETCHES[state]


def even_cuts(cuts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Neighbouring segments joined while their chunk widths are alike (within a
    factor of two): an even order column needs one division, no case distinction."""
    out: list[list] = []                                # start, first chunk, least and greatest width
    for start, first, width in cuts:
        if out and max(out[-1][3], width) <= 2 * min(out[-1][2], width):
            out[-1][2], out[-1][3] = min(out[-1][2], width), max(out[-1][3], width)
        else:
            out.append([start, first, width, width])
    return [(s, f, hi) for s, f, _, hi in out]


def density_chunk(df: DataFrame, order_col: str, target_rows: int = TARGET_ROWS,
                  min_chunks: int = MIN_CHUNKS) -> Column:
    """A chunk number for any BIGINT order column, dense, sparse or bursty.

    The quantiles of the column's kept sketch give segments of about equal row
    counts; each is cut into chunks of equal width.  Values 10^9 apart and
    crowded minutes alike give chunks of about ``target_rows`` rows.  Rows with
    one and the same order value stay in one chunk."""
    n, least, greatest, quantiles = order_sketch(df, order_col)
    if not n:
        return F.lit(0).cast("bigint")
    chunks = max(min_chunks, -(-n // target_rows))
    stride = max(1, SEGMENTS // chunks)                 # few chunks need few segments
    edges = sorted({int(least), *map(int, quantiles[::stride]), int(greatest) + 1})
    cuts = even_cuts(chunk_edges(n, edges, target_rows, min_chunks))
    c = f"CAST(`{order_col}` AS BIGINT)"

    def pick(lo: int, hi: int) -> str:
        if hi - lo == 1:
            a, first, width = cuts[lo]
            return f"({first}L + greatest(0L, {c} - ({a}L)) div {width}L)"
        mid = (lo + hi) // 2
        return f"(CASE WHEN {c} < {cuts[mid][0]}L THEN {pick(lo, mid)} ELSE {pick(mid, hi)} END)"

    return F.when(F.col(order_col).isNotNull(), F.expr(pick(0, len(cuts))))


def chunk_for(df: DataFrame, order_col: str, width: int | None = None) -> Column:
    """Chunks of a given width, else by row density."""
    return chunk_of(order_col, width) if width else density_chunk(df, order_col)
