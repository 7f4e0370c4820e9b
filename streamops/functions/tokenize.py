"""Split a line into words on single spaces (M5), with Java ``split`` rules.

An empty line gives one empty word; trailing empty words are dropped, so a
line of only spaces gives none; leading and inner empty words are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(col: str | Column) -> Column:
    v = F.col(col) if isinstance(col, str) else col
    r = F.rtrim(v)                                     # spaces only, one backward step per space
    return (F.when(v == "", F.array(F.lit("")))
            .when(r == "", F.array().cast("array<string>"))
            .otherwise(F.split(r, " ")))


def tokenize_lines(lines: DataFrame, value_col: str = "value",
                   keep: list[str] | None = None) -> DataFrame:
    """One row per word: keep columns + word_pos (1-based) + word."""
    keep = keep or []
    return lines.select(*keep, F.posexplode(words(value_col)).alias("p", "word")).select(
        *keep, (F.col("p") + 1).cast("bigint").alias("word_pos"), "word")
