"""Packing: ids against the reference tokenizer, placement, the plan."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from streamops.llm import packing
from streamops.llm.common import BATCH
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of, words


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def pack(spark, df, **kw):
    return packing.pack(spark, df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, **kw)


def check(spark, df, tokenizer, capacity=1024):
    got = rows_of(pack(spark, df, capacity=capacity, with_ids=True))
    want = Counter()
    for r in df.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        cut = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for j, (a, z) in enumerate(zip(cut, cut[1:])):
            want[r["doc_id"], j, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes()), tuple(ids[a:z])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))] and sum(n for _, n in p) <= capacity
    return len(places), sum(r["length"] for r in got)


def test_hostile_texts(spark, tokenizer):
    texts = hostile() + ["a  b", " a", "a ", "a \n b", "it's  we'll x", "x y z", "<|endoftext|> a", "  ", "a\u0085 b c",
                         "end.　 next", "1 2  3\t4"]
    check(spark, documents(spark, texts, extra=True), tokenizer)


def test_random_spacing(spark, tokenizer):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["ab", "C", "12", " ", "  ", "\n", "\t", "'s", ".", "é", " ", "!?"]) for _ in range(40))
             for _ in range(300)]
    check(spark, documents(spark, texts), tokenizer, capacity=16)


def test_the_table_needs_few_sequences(spark, tokenizer):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    used, total = check(spark, df, tokenizer)
    assert used <= 1.03 * -(-total // 1024)


def test_repeated_rows_and_empty_table(spark, tokenizer):
    df = documents(spark, [" ".join(words(random.Random(i), 30 + i)) for i in range(20)])
    check(spark, df.union(df), tokenizer)
    assert pack(spark, df.limit(0)).count() == 0
    assert pack(spark, documents(spark, [None, None], ids=[None, 1])).count() == 2


def expand(patterns):
    return Counter(x for runs, times in patterns for x, k in runs for _ in range(k * times))


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    counts = Counter(min(64, int(rng.expovariate(1 / 20)) + 1) for _ in range(rng.choice([1, 10, 3000])))
    patterns = packing.plan(dict(counts), 64)
    assert expand(patterns) == counts
    assert all(sum(x * k for x, k in runs) <= 64 and times > 0 for runs, times in patterns)
    used, least = sum(t for _, t in patterns), -(-sum(x * n for x, n in counts.items()) // 64)
    if sum(counts.values()) > 100:
        assert used <= 1.05 * least + 1


def test_plan_fills_gaps_exactly():
    assert packing.plan({7: 2, 3: 2}, 10) == [(((7, 1), (3, 1)), 2)]
    assert packing.plan({5: 1, 2: 1, 3: 1}, 10) == [(((5, 1), (3, 1), (2, 1)), 1)]
    assert packing.plan({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [(((4, 1), (3, 1), (2, 1), (1, 1)), 1)]
    assert packing.plan({10: 4}, 10) == [(((10, 1),), 4)]
    assert packing.plan({}, 10) == []


def test_plan_size_does_not_follow_the_counts():
    small = packing.plan({n: 3 for n in range(1, 1025)}, 1024)
    large = packing.plan({n: 3_000_000 for n in range(1, 1025)}, 1024)
    assert len(large) < 4 * 1024 and len(large) <= 2 * len(small) + 1024


def test_little_text_is_in_hand_at_a_time(spark, monkeypatch):
    """A batch of much text is encoded in parts, and every row of it."""
    rng = random.Random(6)
    texts = [" ".join(words(rng, 600)) for _ in range(1200)]
    texts[7], texts[8] = None, ""
    largest, encode, run = [], packing.encode_batch, []
    monkeypatch.setattr(packing, "encode_batch", lambda enc, x: largest.append(sum(map(len, x.to_pylist()))) or encode(enc, x))
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": lambda: type("One", (), {"partitionId": lambda: 0})}))
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f) or self)
    path = P.path("byte_bpe_50k.tiktoken")
    packing.pieces(docs, path, P.PATTERN)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1200)), "text": texts})
    assert sum(len(t or "") for t in texts) > 2 * packing.PART
    got = {}
    for b in run[0](iter([batch])):
        for r in b.to_pylist():
            got.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert max(largest) <= packing.PART + max(len(t or "") for t in texts)
    enc = packing.encoder(path, P.PATTERN)
    for i in range(1200):
        assert sum(n for _, n in got[i]) == len(enc.encode_ordinary(texts[i] or "")) + 1


def test_batches_and_output_stay_small(spark):
    """Long texts reach the workers in batches of about BATCH bytes, and the
    placed pieces are in as many partitions as the pieces are read in."""
    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat(id, ' words '), 400) AS text")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        placed = pack(spark, docs.limit(40))
        assert placed.rdd.getNumPartitions() < 16 and len({r["doc_id"] for r in placed.collect()}) == 40
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    got = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in got) == 3000 and max(r["bytes"] for r in got) < 2 * BATCH < sum(r["bytes"] for r in got)
