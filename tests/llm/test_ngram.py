"""The Kneser-Ney model against a dictionary version of the same formulas."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from streamops.llm import ngram
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


def discounts(values):
    n = Counter(values)
    if not n[1] or not n[2]:
        return (0.5, 0.5, 0.5)
    y = n[1] / (n[1] + 2 * n[2])
    d2 = 2 - 3 * y * n[3] / n[2]
    return (1 - 2 * y * n[2] / n[1], min(2.0, max(0.0, d2)),
            min(3.0, max(0.0, 3 - 4 * y * n[4] / n[3])) if n[3] else max(0.0, d2))


def brute(rows):
    tok = [[*WORD.findall(lower(t)), b" "] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    train = [t for t, h in zip(tok, held) if not h]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    pair = Counter(p for t in train for p in zip([None, *t], t))
    before, follow, ctx = Counter(w for _, w in pair), defaultdict(Counter), Counter()
    for (a, _), k in pair.items():
        follow[a][min(k, 3)] += 1
        ctx[a] += k
    dp, dw = discounts(pair.values()), discounts(before.values())

    def cut(k, d):
        return k - (d[min(k, 3) - 1] if k else 0)

    g0 = sum(dw[min(k, 3) - 1] for k in before.values()) / max(1, len(pair))

    def p(a, w):
        low = cut(before[w], dw) / max(1, len(pair)) + g0 / (v + 1) if pair else 1 / (v + 1)
        if not ctx[a]:
            return low
        return cut(pair[a, w], dp) / ctx[a] + sum(dp[k - 1] * m for k, m in follow[a].items()) / ctx[a] * low

    out = []
    for (i, _), t, h in zip(rows, tok, held):
        out.append((i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t),
                    sum(math.log10(p(a, w)) for a, w in zip([None, *t], t))))
    return out, (p, c)


def compare(spark, df, **kw):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0], r[2], round(r[5], 6))
    got = sorted((tuple(r.values()) for r in rows_of(ngram.score(spark, df, **kw))), key=key)
    want = sorted(brute(rows)[0], key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def small(seed, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["a", "B", "b", "cc", "d", "É", "é", "ff"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("range_tokens", [50, 2_000_000])
def test_against_dictionaries(spark, range_tokens):
    compare(spark, documents(spark, small(1) + hostile(), extra=True), range_tokens=range_tokens)


def test_hot_pair_and_large_counts(spark):
    compare(spark, documents(spark, ["x y " * 400] * 30 + small(2)), range_tokens=500)


def test_the_table(spark):
    compare(spark, spark.read.parquet(f"{SF001}/documents.parquet"), range_tokens=20_000)


def test_empty_repeated_and_null_rows(spark):
    df = documents(spark, small(3, 10))
    assert ngram.score(spark, df.limit(0)).count() == 0
    compare(spark, df.union(df))
    compare(spark, documents(spark, [None, None, "a b"]))
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = rows_of(ngram.score(spark, documents(spark, ["nothing to learn"], ids=[held])))[0]   # no training text at all
    assert (r["held_out"], r["train_tokens"], r["n_known"], r["score"], r["base_score"]) == (True, 0, 0, 0.0, 0.0)


def test_probabilities_sum_to_one():
    rows = [(i, t) for i, t in enumerate(small(5))]
    _, (p, c) = brute(rows)
    for a in (None, b"a", b"cc", b"never"):
        assert sum(p(a, w) for w in c) + p(a, b"unseen") == pytest.approx(1.0)


def test_mix_is_a_bijection():
    x = np.random.default_rng(0).integers(0, 1 << 63, 10_000).astype(np.uint64) * np.uint64(2)
    assert (ngram.unmix64(ngram.mix64(x)) == x).all()
