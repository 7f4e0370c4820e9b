"""Small hostile tables, and helpers."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def documents(spark, texts, extra=False, langs=None, sources=None, ids=None):
    rows = [(i if ids is None else ids[i], t, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i],
             None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:                                          # names that operators use inside
        from pyspark.sql import functions as F
        for c in ("_id", "_row", "_doc", "removed", "kept", "_t", "part", "score", "length"):
            df = df.withColumn(c, F.lit("x"))
    return df


def words(rng: random.Random, n: int, alphabet="etaoinshrdlu") -> list[str]:
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(n)]


def hostile(rng: random.Random | None = None) -> list[str | None]:
    """Null, empty, blank, one word, long, non-ASCII, control characters."""
    rng = rng or random.Random(7)
    long = " ".join(words(rng, 4000))
    return [None, "", " ", "\n\n", "word", "\x0b\x0cone\x1c two\x85three four five", "ß É ñ 漢字 😀 á",
            long, long, "x" * 50_000, " ".join(["same"] * 600), "a\nb\na\nb\n\n a\n", "\ttabs  and   runs \r\n end"]
