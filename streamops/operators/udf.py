"""Hooks for opaque user functions, all Arrow-batched.

Prefer Column expressions; use these only when a function cannot be written
with built-in functions.  Map and flat-map run per Arrow batch (a Python table
function per row where one is wanted).  The grouped aggregate and the full-window
function hold one whole group in the memory of one task and have no partial
results, so they suit groups of bounded size only: for large or hot groups use
the built-in aggregates (``streamops.operators.windows``), which combine
map-side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators.windows import assign_tumbling


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """MapFunction / FlatMapFunction: ``fn`` maps one pandas batch to any
    number of output rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def series_function(fn: Callable[[pd.Series], pd.Series], return_type: str):
    """A scalar pandas UDF (vectorised, Arrow transfer)."""

    def scalar(v: pd.Series) -> pd.Series:
        return fn(v)

    return F.pandas_udf(scalar, return_type)


def grouped_aggregate(fn: Callable[[pd.Series], object], return_type: str):
    """AggregateFunction: a grouped-aggregate pandas UDF, for ``groupBy().agg``.
    The ``Series -> scalar`` hints tell Spark it is an aggregate."""

    def agg(v: pd.Series) -> float:
        return fn(v)

    return F.pandas_udf(agg, return_type)


def window_process_pandas(df: DataFrame, size_ms: int, fn: Callable[[pd.DataFrame], pd.DataFrame],
                          schema: str, key: str = "id", time: str = "ts_ms") -> DataFrame:
    """ProcessWindowFunction: ``fn`` receives all rows of one (key, tumbling
    window), with ``w_start`` / ``w_end`` columns."""
    return assign_tumbling(df, size_ms, time).groupBy(key, "w_start").applyInPandas(fn, schema)


def flat_map_rows(df: DataFrame, fn: Callable[..., object], schema: str, *cols: str) -> DataFrame:
    """FlatMapFunction as a Python table function: ``fn(*values)`` gives any
    number of tuples of ``schema`` for each row; the row's columns are kept."""

    class Rows:
        def eval(self, *values):
            yield from fn(*values)

    table = F.udtf(Rows, returnType=schema, useArrow=True)
    return df.lateralJoin(table(*[F.col(c).outer() for c in cols]))
