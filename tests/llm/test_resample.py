"""Importance resampling against a reading of the contract, document by document."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from streamops.llm import resample
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, order=1, buckets=10_000, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, order)[1])
    t = Counter(bucket(f) for x in target for f in features(x, order)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, (doc, text) in enumerate(docs):
        w, fs = features(text, order)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, fs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(fs), weight, score, None, len(w) >= least])
    may = sorted((r for r in out if r[5]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], -r[2], -r[1]))
    for rank, r in enumerate(may[:len(may) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def check(spark, df, target, **kw):
    got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows_of(
        resample.resample(spark, df, target, **{"min_words": kw.get("least", 20), **{k: v for k, v in kw.items() if k != "least"}}))]
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()], [r["text"] for r in target.collect()], **kw)
    assert sorted(got, key=str) == want
    return got


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_hostile_texts_and_clashing_columns(spark, order):
    df = documents(spark, hostile() + ["Ab ab AB éÉ", "a.b,c;d"], extra=True).withColumnRenamed("score", "rank").withColumnRenamed("part", "weight")
    check(spark, df, documents(spark, ["ab éÉ word", None]), order=order, percent=60, least=2)


def test_ties_null_and_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(25))
    df = documents(spark, [t, t, t, t + " x", t, None], ids=[4, 4, None, 4, 9, 9])
    check(spark, df, documents(spark, ["w1 w2"]), percent=70)


@pytest.mark.parametrize("buckets", [1, 7])
def test_few_buckets_make_equal_weights(spark, buckets):
    import random
    rng = random.Random(2)
    df = documents(spark, [" ".join(words(rng, 30)) for _ in range(400)])
    got = check(spark, df, documents(spark, [" ".join(words(rng, 30))]), buckets=buckets)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 41))


def test_empty_tables(spark):
    none = documents(spark, [])
    assert rows_of(resample.resample(spark, none, none)) == []
    check(spark, documents(spark, ["a " * 30] * 20), none)
    check(spark, documents(spark, ["a " * 3] * 20), documents(spark, ["a"]))       # nobody may be drawn


def test_draws_prefer_the_target(spark):
    """Documents in the target's words are drawn first, others still have a chance."""
    like, other = [f"t{i}" for i in range(50)], [f"o{i}" for i in range(50)]
    df = documents(spark, [" ".join((like if i % 10 == 0 else other)[j:j + 30]) for i in range(500) for j in (i % 20,)])
    got = check(spark, df, documents(spark, [" ".join(like)] * 40))
    drawn = [r[0] % 10 == 0 for r in got if r[4]]
    assert len(drawn) == 50 and sum(drawn) > 35


def test_the_table(spark):
    check(spark, spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet"))


def test_query_matches_sql(spark, con001):
    from streamops.llm.queries import ORACLE, QUERIES
    from tests.oracle import compare
    df = QUERIES["op12_importance_resampling"](spark, SF001)
    assert dict(df.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    ok, msg = compare(df, con001, ORACLE["op12_importance_resampling"])
    assert ok, msg
