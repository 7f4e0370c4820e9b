"""Operator 12: resampling by importance towards a target distribution.

Texts are bags of hashed n-grams.  A bucket's *gain* is the log ratio of its
share in the target texts and in the documents; a document's weight is the mean
gain of its n-grams; Gumbel noise from a hash of its id makes the k greatest
scores a draw without replacement, in proportion to the exponential of the
weights.

The work on text is Arrow kernels: ``ascii_lower``, ``split_pattern_regex`` and
``list_flatten`` give the words, ``dictionary_encode`` their numbers; the numbers
shifted by 1, 2, ... make the n-grams; each distinct n-gram of a part gets its
CRC once; ``take`` and a segment sum give a document's gain.

Scale.  Two reads of the text, no text is moved.

* Counts: a part sends a row for each bucket it has seen; at most ``BUCKETS``
  rows come to the driver, as the gains go back with the tasks.
* Scores go to a table of a few numbers for each document.  How many documents
  have each score is a table of at most the range of scores (weights and noise
  are thousandths of logarithms, so about 10^5 whole numbers, whatever the
  corpus); from it come the lowest score drawn and how many lie above each.
* Ranks: documents of one score are put in order of their id, in as many tasks
  as there are scores, and the number above is added.

Results for odd input: a null text has no words and a weight of 0; a null id
counts as an empty string in the hash and comes first among equal scores; rows
that share an id have the same noise and rank in order of weight and size;
equal scores rank by the smaller id; without target texts, or without any
documents, each gain is that of the smoothing alone; an empty table gives an
empty result; other columns are not read.  Long texts are handled whole, about
60 bytes a word while a part is worked on.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamops.llm.common import settle, some_texts

#: What is no word, after lower-casing: all of ASCII but digits and letters.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Longest n-gram.
ORDER = 1
#: Documents of fewer words are never drawn.
MIN_WORDS = 20
#: Percent of the others that are drawn.
PERCENT = 10
SEED = "2024"


class Grams:
    """The n-grams of some texts: ``bucket`` of each distinct n-gram, ``number``
    of every n-gram into it, ``text`` it is in; ``words`` and ``size`` (n-grams)
    of each text."""

    def __init__(self, texts: pa.Array, order: int, buckets: int):
        lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BREAK)
        flat, offsets = pc.list_flatten(lists), lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        keep = pc.not_equal(pc.binary_length(flat), 0)      # before a leading and after a trailing break
        before = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False))))
        offsets, flat = before[offsets], flat.filter(keep)
        coded = flat.dictionary_encode()
        names = [w.encode() for w in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = np.diff(offsets)
        owner = np.repeat(np.arange(len(texts)), self.words)
        crc = np.fromiter((zlib.crc32(w) for w in names), np.int64, len(names))
        numbers, owners, values, base, first = [codes], [owner], [crc], len(names), codes
        for n in range(2, order + 1):
            # (the n-1-gram here, the word n-1 further on) within one text; distinct pairs get a number
            here = np.flatnonzero(owner[n - 1:] == owner[:max(0, len(owner) - n + 1)])
            pair = first[here] * max(1, len(names)) + codes[here + n - 1]
            pairs, at, inverse = np.unique(pair, return_index=True, return_inverse=True)
            spot = here[at]
            made = (b" ".join(names[codes[s + i]] for i in range(n)) for s in spot)
            values.append(np.fromiter((zlib.crc32(g) for g in made), np.int64, len(pairs)))
            numbers.append(inverse + base)
            owners.append(owner[here])
            base += len(pairs)
            first = np.zeros(len(owner), np.int64)
            first[here] = inverse
        self.bucket = np.concatenate(values) % buckets
        self.number, self.text = np.concatenate(numbers), np.concatenate(owners)
        self.size = np.bincount(self.text, minlength=len(texts))

    def counts(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket[self.number], minlength=buckets)

    def gain(self, gains: np.ndarray) -> np.ndarray:
        """The sum of each text's gains."""
        each = pa.array(gains).take(pa.array(self.bucket)).take(pa.array(self.number)).to_numpy()
        total = np.concatenate(([0], np.cumsum(each[np.argsort(self.text, kind="stable")])))
        end = np.cumsum(self.size)
        return total[end] - total[end - self.size]


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many n-grams of all ``texts`` fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]):
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for _, some in some_texts(b.column(0)):
                n += Grams(some, order, buckets).counts(buckets)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, in thousandths, rounded down."""
    s, t = (dict(bucket_counts(x, order, buckets).collect()) for x in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    return np.array([math.floor(1000 * math.log((t.get(b, 0) + 1) * (all_s + buckets) / ((s.get(b, 0) + 1) * (all_t + buckets))))
                     for b in range(buckets)], np.int64)


def scores(docs: DataFrame, gains: np.ndarray, order: int = ORDER, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for a, some in some_texts(b.column("text")):
                g = Grams(some, order, buckets)
                weight = np.where(g.size > 0, g.gain(gains) // np.maximum(g.size, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(a, len(some)), pa.array(g.words, pa.int64()), pa.array(g.size, pa.int64()),
                     pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    each = docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {id_type}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return each.withColumn("score", F.col("weight") + noise)


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             min_words: int = MIN_WORDS, order: int = ORDER, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """Every row's n_features, weight and score, and its rank if it is drawn."""
    table = settle(spark, scores(docs, bucket_gains(docs, target, order, buckets), order, seed), "scores")
    may = F.col("n_words") >= min_words
    per = table.where(may).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    draw, passed, above = sum(r["n"] for r in per) * percent // 100, 0, {}
    for r in sorted(per, key=lambda r: -r["score"]):
        if passed < draw:
            above[r["score"]] = passed
            passed += r["n"]
    rest = table.withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    if not above:
        return rest.select(*out)
    ahead = spark.createDataFrame(list(above.items()), "score long, above long")
    order_in = Window.partitionBy("score").orderBy("doc_id", F.desc("weight"), F.desc("n_features"))
    high = may & (F.col("score") >= min(above))
    ranked = table.where(high).join(F.broadcast(ahead), "score").withColumn("rank", F.col("above") + F.row_number().over(order_in))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return ranked.select(*out).unionByName(rest.where(~high).select(*out))
