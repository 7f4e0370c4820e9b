"""Projection, filter, flat-map and routing (M2-M4, M6-M9).

Routing computes the route column once; each output is a ``where`` on it.
In a streaming query the routed frame is persisted inside ``foreachBatch``
(see ``streamops.streaming.router``) so the input is read once for all
outputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAIN = "main"


def map_project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows whose ``col`` equals ``value``; NULL never matches."""
    return df.where(F.col(col) == F.lit(value))


def flatmap_by_key(df: DataFrame, key: str, emit: Mapping[str, Sequence[str]],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Zero or more outputs per row: ``emit[key value]`` lists the columns
    whose values are emitted (cast to BIGINT), in order; other keys emit none."""
    branches = None
    for k, cols in emit.items():
        arr = F.array(*[F.col(c).cast("bigint") for c in cols])
        branches = (F.when(F.col(key) == F.lit(k), arr) if branches is None
                    else branches.when(F.col(key) == F.lit(k), arr))
    arr = branches.otherwise(F.array().cast("array<bigint>"))
    return df.select(*keep, F.posexplode(arr).alias("p", "value")).select(
        *keep, (F.col("p") + 1).cast("bigint").alias("out_pos"), "value")


def map_increment(df: DataFrame, col: str, keep: Sequence[str] = (), by: int = 1) -> DataFrame:
    return df.select(*keep, (F.col(col) + F.lit(by)).alias("value"))


def with_task_lifecycle(df: DataFrame, setup, row_fn, teardown, schema: str) -> DataFrame:
    """Rich map: ``setup`` once per task, ``row_fn(state, pdf)`` per Arrow
    batch, ``teardown(state)`` once per task even when the task fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = setup()
        try:
            for pdf in batches:
                yield row_fn(state, pdf)
        finally:
            teardown(state)

    return df.mapInPandas(run, schema)


def split_even_odd(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Java ``%`` keeps the dividend's sign: negative odd numbers match neither
    ``% 2 == 0`` nor ``% 2 == 1``.  Spark's ``%`` behaves the same."""
    even = df.where(F.col(col) % 2 == 0)
    odd = df.where(F.col(col) % 2 == 1)
    return even, odd


def with_route(df: DataFrame, key: str, tags: Mapping[str, str], route_col: str = "route") -> DataFrame:
    """Tag each row with exactly one route: ``tags[key value]`` or ``main``."""
    r = None
    for k, tag in tags.items():
        r = F.when(F.col(key) == F.lit(k), F.lit(tag)) if r is None else r.when(F.col(key) == F.lit(k), F.lit(tag))
    return df.withColumn(route_col, r.otherwise(F.lit(MAIN)) if r is not None else F.lit(MAIN))


def route_outputs(df: DataFrame, key: str, tags: Mapping[str, str]) -> dict[str, DataFrame]:
    routed = with_route(df, key, tags)
    names = [MAIN] + list(dict.fromkeys(tags.values()))
    return {n: routed.where(F.col("route") == F.lit(n)).drop("route") for n in names}


def alarm_split(df: DataFrame, col: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Main output keeps every row; the alarm output copies rows above the
    threshold (strict)."""
    return df, df.where(F.col(col) > F.lit(threshold))
