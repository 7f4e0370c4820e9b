"""Near-duplicate classes against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from streamops.llm import minhash
from streamops.llm.common import sieve
from streamops.llm.components import components
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of, words


def shingle_set(text):
    w = ["".join(c.lower() if c.isascii() else c for c in x) for x in split(text or "")]
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def split(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute(rows, floor=minhash.FLOOR, similar=minhash.SIMILAR):
    """Classes of rows by all pairs of distinct texts that share a shingle."""
    texts = sorted({t or "" for _, t in rows})
    sets = {t: shingle_set(t) for t in texts}
    family, df = {}, defaultdict(set)
    raw = {t: minhash.shingles(pa.array([t]))[0] for t in texts}
    for t in texts:
        family[t] = int(raw[t][0]) if len(raw[t]) else None
        for s in sets[t]:
            df[s].add(family[t])
    n = len(rows)
    weight = {s: math.log1p(n / max(len(f), floor * n)) for s, f in df.items()}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    holders = defaultdict(list)
    for t in texts:
        for s in sets[t]:
            holders[s].append(t)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[:i]}
    for a, b in pairs:
        both = sum(weight[s] * min(sets[a][s], sets[b][s]) for s in sets[a] if s in sets[b])
        whole = sum(weight[s] * k for s, k in sets[a].items()) + sum(weight[s] * k for s, k in sets[b].items()) - both
        if both / whole >= similar:
            root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, t in rows:
        groups[find(t or "")].append(i)
    return sorted(sorted(g, key=lambda i: (i is None, i)) for g in groups.values())


def grouped(got):
    groups = defaultdict(list)
    for r in got:
        groups[r["class_id"]].append(r["doc_id"])
    return sorted(sorted(g) for g in groups.values())


def near(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = "".join(rng.choice("xyz") for _ in range(6))
    return " ".join(w)


def mixed(seed=1):
    rng = random.Random(seed)
    line = " ".join(words(rng, 12))
    texts = list(hostile(rng)[:8])
    for _ in range(25):
        base = " ".join(words(rng, rng.randint(60, 300)))
        texts += [base] * rng.randint(1, 3)
        texts += [near(rng, base, rng.randint(0, 3)) for _ in range(rng.randint(0, 4))]
        texts.append(line + " " + " ".join(words(rng, 80)))       # a line that many share
    big = " ".join(words(rng, 200))
    texts += [near(rng, big, 1) for _ in range(60)]               # one large group of near copies
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    df = documents(spark, mixed(seed), extra=True)
    got = rows_of(minhash.near_duplicates(spark, df))
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert grouped(got) == want
    size = Counter(r["class_id"] for r in got)
    assert all(r["class_size"] == size[r["class_id"]] and r["class_id"] <= r["doc_id"] for r in got)


def test_the_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert grouped(rows_of(minhash.near_duplicates(spark, df))) == brute(rows)


def test_dedupe_keeps_one_of_each_class(spark):
    df = documents(spark, mixed(4), extra=True)
    want = [g[0] for g in brute([(r["doc_id"], r["text"]) for r in df.collect()])]
    out = minhash.dedupe(spark, df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in rows_of(out)) == sorted(want)
    assert sorted(r["doc_id"] for r in rows_of(minhash.dedupe(spark, df.union(df)))) == sorted(want)   # repeated rows


def test_edges(spark):
    df = documents(spark, ["a b"])
    assert minhash.near_duplicates(spark, df.limit(0)).count() == 0 and minhash.dedupe(spark, df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None, None, None, None), (3, "", None, None, None), (None, "x y", None, None, None),
                                  (4, " ", None, None, None), (5, "X  y", None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in rows_of(minhash.near_duplicates(spark, null))),
                 key=str)
    assert got == sorted([(None, 3, 2), (3, 3, 2), (4, 4, 1), (None, 5, 2), (5, 5, 2)], key=str)
    assert sorted(r["doc_id"] for r in rows_of(minhash.dedupe(spark, null))) == [3, 4, 5]


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(8)
    h = np.sort(rng.choice(1 << 47, 4000, replace=False).astype(np.uint64))
    wa, wb = rng.uniform(0.5, 3, 4000), rng.uniform(0.5, 3, 4000)
    hits = total = 0
    for k in range(60):                                 # other shingles, the same weights
        g = np.sort(minhash.mix(h + np.uint64(k * 7919)) & minhash.MASK)
        sa = minhash.samples(g, wa, np.array([0, len(g)]))
        sb = minhash.samples(g, wb, np.array([0, len(g)]))
        hits, total = hits + int((sa == sb).sum()), total + minhash.SAMPLES
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs(hits / total - want) < 0.05


def test_common_shingles_are_found_exactly(spark):
    rng = random.Random(6)
    line = "this line is in very many documents of the table"
    texts = [line + " " + " ".join(words(rng, 30)) for _ in range(300)] + [" ".join(words(rng, 30)) for _ in range(900)]
    total, h, n = minhash.common_shingles(spark, documents(spark, texts).repartition(7))
    assert total == 1200
    want = sorted(minhash.shingles(pa.array([line]))[0].tolist())
    assert set(want) <= set(h.tolist()) and all(n[np.searchsorted(h, x)] >= 250 for x in want)


def test_pairs_among_many_texts_with_one_passage(spark):
    rng = random.Random(11)
    passage, own = " ".join(words(rng, 300)), []
    for i in range(500):
        own.append([f"o{i}n{k}" for k in range(60)])
    for i in range(40):                                 # 0.8 alike with the passage, which most buckets consist of
        own.append([*own[i][:28], *(f"p{i}n{k}" for k in range(28, 60))])
    df = documents(spark, [passage + " " + " ".join(w) for w in own])
    common = minhash.common_shingles(spark, df)
    h, tf, offs = minhash.shingles(pa.array([r["text"] for r in df.collect()]))
    w = minhash.weights(h, tf, common)
    cut = [slice(a, z) for a, z in zip(offs[:-1], offs[1:])]
    some = {(0, b) for b in range(1, len(cut))} | {(i, 500 + i) for i in range(40)}
    like = {(a, b): minhash.similarity(h[cut[a]], w[cut[a]], h[cut[b]], w[cut[b]]) for a, b in some}
    want = sorted(p for p, s in like.items() if s >= minhash.SIMILAR)
    assert want == [(i, 500 + i) for i in range(40)] and sum(s > 0.6 for s in like.values()) > 500
    classes = defaultdict(list)
    for r in rows_of(minhash.near_duplicates(spark, df)):
        classes[r["class_id"]].append(r["doc_id"])
    assert sorted(tuple(sorted(c)) for c in classes.values() if len(c) > 1) == want


def test_outlines_never_rule_out_a_link():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.choice(1 << 47, 6000, replace=False).astype(np.uint64))
    for n, m, times in ((3, 3, 1), (300, 340, 1), (2500, 3100, 3), (40, 50, 4000), (1, 5000, 2)):
        base = rng.permutation(pool)[:max(n, m)]
        ha, hb = np.sort(base[:n]), np.sort(base[-m:])
        wa, wb = rng.integers(1, times + 1, n) * np.log1p(100), rng.integers(1, times + 1, m) * rng.uniform(0.5, 4.6, m)
        a, b = (minhash.outlines(h, w, np.array([0, len(h)]))[0].as_py() for h, w in ((ha, wa), (hb, wb)))
        _, at, to = np.intersect1d(ha, hb, return_indices=True)
        both = np.minimum(wa[at], wb[to]).sum()
        assert minhash.most_shared(a, b) >= both * (1 - 1e-9) and minhash.most_shared(b, a) == minhash.most_shared(a, b)
    far = [minhash.outlines(h, np.full(400, np.log1p(100)), np.array([0, 400]))[0].as_py()
           for h in (np.sort(pool[::2][:400]), np.sort(pool[1::2][:400]))]
    assert minhash.most_shared(*far) < 2 * 0.8 / 1.8 * 400 * np.log1p(100)


def test_sieve_passes_only_rows_without_the_keys(spark):
    rows = spark.range(3000).selectExpr("id as k", "cast(id % 7 as string) as s")
    few = rows.where("k % 50 = 0").select("k", "s")
    sure, some = sieve(spark, rows, few, ["k", "s"])
    assert sorted(r["k"] for r in sure.union(some).collect()) == list(range(3000))
    assert some.join(few, ["k", "s"]).count() == 60 and some.count() < 100
    assert sieve(spark, rows, few.limit(0), ["k", "s"])[1].count() == 0


def test_sieve_runs_no_python_and_marks_every_key(spark):
    rows = spark.range(300_000).selectExpr("id as k", "if(id % 7 = 0, null, cast(id % 7 as string)) as s")
    few = rows.where("k % 50 = 0").select("k", "s")
    sure, some = sieve(spark, rows, few, ["k", "s"])
    assert sure.columns == some.columns == rows.columns
    doubted = {r["k"] for r in some.collect()}
    # 6000 keys lie in every piece and octet of the bitmap; about 54 other rows share a bit with one of them
    assert doubted >= set(range(0, 300_000, 50)) and len(doubted) < 6200
    assert sorted([r["k"] for r in sure.collect()] + list(doubted)) == list(range(300_000))
    for df in (sure, some):
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop",
                             df._jdf.queryExecution().executedPlan().toString())


def test_copies_of_one_source_too_far_apart_make_no_pairs(spark):
    """0.85 of each text is its source's, 0.74 alike: all share a bucket, and no pair is left to compare."""
    rng = np.random.default_rng(9)
    pool = np.unique(rng.integers(0, 1 << 47, 20_000).astype(np.uint64))
    own, source = pool[:9000].reshape(60, 150), rng.permutation(pool[9000:10_000])
    weight = 1000 * np.log1p(100)
    nodes = [bytes([i]) * 16 for i in range(60)]
    texts = [np.sort(np.concatenate((own[i], source[np.setdiff1d(np.arange(1000), rng.choice(1000, 150, replace=False))])))
             for i in range(60)]
    member = spark.createDataFrame([(1, n) for n in nodes], "band long, node binary")
    none = spark.createDataFrame([], "node binary, label binary")
    light = spark.createDataFrame([(n, float(weight)) for n in nodes], "node binary, whole double")
    vecs = spark.createDataFrame([(n, minhash.packed(h), minhash.counts(np.ones(1000, np.int64)))
                                  for n, h in zip(nodes, texts)], "node binary, h binary, tf binary")
    common = (60, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert minhash.rest(spark, member, none, light, vecs, common, minhash.SIMILAR).count() == 0
    assert minhash.across(member, none).count() == 0    # no class to join


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(60)] + [(f"h{rng.randint(0, 40)}", f"h{rng.randint(0, 40)}")
                                                                for _ in range(30)] + [("hub", f"s{i}") for i in range(200)]
    df = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["label"]) for r in components(spark, df).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a.encode()), find(b.encode())
        root[max(a, b)] = min(a, b)
    assert all(got[x] == find(x) for x in got)
    assert set(got) == {x for a, b in edges if a != b for x in (a.encode(), b.encode())}
