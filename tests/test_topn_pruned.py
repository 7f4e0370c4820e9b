"""Top-N by a sketch's candidates equals the exact top-N, proven or not."""

import random
from collections import Counter

import pytest

from streamops.operators import topn


def rows(seed, n=6000):
    """A few frequent values among thousands in some windows, even ones in others."""
    rng = random.Random(seed)
    out = []
    for a in range(n):
        t = rng.randrange(0, 1000)
        if t < 500 and rng.random() < 0.4:
            v = rng.choice([1, 1, 1, 2, 2, 3])
        else:
            v = None if rng.random() < 0.05 else rng.randrange(100, 5000)
        out.append((t, v))
    return out


def brute(data, n, size, slide):
    out = []
    for start in range(-size // slide * slide, 1000 + size, slide):
        c = Counter(v for t, v in data if start <= t < start + size)
        best = sorted(c.items(), key=lambda x: (-x[1], -1 if x[0] is None else x[0]))[:n]
        out += [(start, start + size, i + 1, v, k) for i, (v, k) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("items", [30, 200, 20_000])
def test_pruned_equals_exact(spark, items):
    data = rows(items)
    df = spark.createDataFrame(data, "ts_ms bigint, vc int")
    for size, slide in ((200, 100), (150, 100)):
        want = brute(data, 3, size, slide)
        got = topn.topn_pruned(df, 3, size, slide, items=items)
        assert sorted(map(tuple, got.collect()), key=str) == want
        assert sorted(map(tuple, topn.topn_all_window(df, 3, size, slide).collect()), key=str) == want
    proven = {r["proven"] for r in topn.pruned_candidates(df, 3, 200, 100, items=items).collect()}
    assert proven == {30: {False}, 200: {True, False}, 20_000: {True}}[items]


def test_no_rows(spark):
    assert topn.topn_pruned(spark.createDataFrame([], "ts_ms bigint, vc int"), 2, 10, 5).count() == 0
