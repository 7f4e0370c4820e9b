"""Side outputs on a stream: compute the route once per micro-batch, persist,
and write every route from the same rows (M8, M9, WM8)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators.transform import with_route


def route_batches(key: str, tags: Mapping[str, str],
                  writers: Mapping[str, Callable[[DataFrame, int], None]]):
    """``foreachBatch`` function: one pass over the input, one writer per route."""

    def run(batch: DataFrame, batch_id: int) -> None:
        routed = with_route(batch, key, tags).persist()
        try:
            for name, write in writers.items():
                write(routed.where(F.col("route") == F.lit(name)).drop("route"), batch_id)
        finally:
            routed.unpersist()

    return run
