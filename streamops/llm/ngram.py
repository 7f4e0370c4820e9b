"""Perplexity from an interpolated modified Kneser-Ney model, counted in Spark.

Three passes over the text, and tables that grow with the corpus:

1. words: each task counts its distinct words and sends (hash, count) pairs,
   packed into one blob for each hash range; one task per range merges them and
   writes a sorted array file.  A word's number is its place in these arrays.
2. pairs: each task counts its distinct (previous, current) pairs of word
   numbers.  A pair packs into 64 bits, and a bijective mix makes it a hash
   without collisions, so ranges are even whatever the words; merged ranges are
   written as sorted hash arrays with one-byte counts (larger ones in a side
   array).  The same tasks send per-word sums: how many distinct words come
   before it, and how many of its followers were seen once, twice, more often.
3. scores: workers memory-map the arrays and look up the sorted distinct words
   and pairs of each batch.

Tasks pre-aggregate before anything is shuffled, so a word or pair that makes
up a third of the text is one entry of each task.  The number of ranges follows
the corpus, so a merging task has a bounded share of it.

The model has order 2: P(w | v) = (c(vw) - D) / c(v) + g(v) P(w), with P(w) from
the numbers of distinct predecessors, itself discounted and interpolated with
1 / (V + 1).  A word not seen in training has the last term alone.

Defined results: a null text is empty (its end alone is scored); without any
training text every token has 1 / (V + 1) = 1 and scores are 0; repeated rows
count as often as they occur; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import functools
import math
import posixpath
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import MIX, MIX2, as_text, filesystem, hash_words, local_path, scratch_path, settle, some_texts, split_words

END = np.uint64(xxhash.xxh3_64_intdigest(b" "))     # no word is a blank
BEGIN = np.uint64(0xFFFFFFFF)                       # the number of the text's begin
UNKNOWN = np.uint64(0xFFFFFFFE)
RANGE_TOKENS = 2_000_000                            # tokens for each range
FLUSH = 8_000_000                                   # entries a task holds before it merges them
MOD, HELD = 7, 2                                    # fixed by the contract


# ----------------------------------------------------------------- hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers onto themselves."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX2
    return x ^ (x >> np.uint64(32))


def unmix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(pow(int(MIX2), -1, 1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(pow(int(MIX), -1, 1 << 64))
    return x ^ (x >> np.uint64(32))


def range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width; the top 32 bits decide."""
    return ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def merged(keys: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct keys and the sums of their values."""
    k = np.concatenate(keys)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    if not len(at):
        return k, [np.concatenate(v) for v in values]
    return k[at], [np.add.reduceat(np.concatenate(v)[order], at) for v in values]


def blobs(keys: np.ndarray, values: list[np.ndarray], where: np.ndarray, ranges: int, kinds: list[str]) -> pa.RecordBatch:
    """One row for each range: its number and the packed arrays."""
    cut = np.searchsorted(where, np.arange(ranges + 1, dtype=where.dtype))
    rows = [i for i in range(ranges) if cut[i] < cut[i + 1]]
    cols = [pa.array(rows, pa.int32())]
    for a, kind in zip([keys, *values], kinds):
        cols.append(pa.array([a[cut[i]:cut[i + 1]].astype(kind).tobytes() for i in rows], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, ["part", *(f"b{i}" for i in range(len(kinds)))])


class Tally:
    """Sums per key, merged whenever many entries have come together."""

    def __init__(self):
        self.keys, self.values, self.size = [], [], 0

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values = self.values or [[] for _ in values]
        for have, v in zip(self.values, values):
            have.append(v)
        self.size += len(keys)
        if self.size > FLUSH:
            k, v = merged(self.keys, self.values)
            self.keys, self.values = [k], [[x] for x in v]
            self.size = len(k) if len(k) < FLUSH // 2 else 0

    def done(self) -> tuple[np.ndarray, list[np.ndarray]]:
        return merged(self.keys, self.values)


# ------------------------------------------------------------------- tokens


def tokens(col) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return split_words(pc.ascii_lower(as_text(col)))


def parts_of(batches, text: int, size: int = 1 << 23):
    """The batches in parts of about ``size`` bytes of text."""
    for b in batches:
        for a, texts in some_texts(b.column(text), size):
            yield b.slice(a, len(texts))


def with_ends(word: np.ndarray, offs: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The token stream with an end after each text, and its offsets."""
    n = len(offs) - 1
    own = offs + np.arange(n + 1)
    out = np.empty(len(word) + n, word.dtype)
    ends = own[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = word, end
    return out, own


def pairs(ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Every token with the one before it, packed into 64 bits."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[own[:-1]] = BEGIN
    return (before << np.uint64(32)) | ids


# ------------------------------------------------------------- stored arrays


@functools.lru_cache(maxsize=4096)
def array(uri: str, kind: str) -> np.ndarray:
    """A stored array, memory-mapped where the folder is mounted."""
    fs, path = filesystem(uri)
    if uri.startswith(("file:", "/")):
        path = local_path(uri)
        try:
            return np.memmap(path, kind, "r")
        except ValueError:                          # an empty file cannot be mapped
            return np.zeros(0, kind)
    return np.frombuffer(fs.open_input_file(path).read(), kind)


def store(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Whole files under their final names: written aside, then moved.  What a
    repeated task finds in place has the same content and stays."""
    fs, top = filesystem(folder)
    fs.create_dir(top, recursive=True)
    for i, a in enumerate(arrays):
        final = posixpath.join(top, f"{name}.{i}")
        aside = f"{final}.{uuid.uuid4().hex}"
        with fs.open_output_stream(aside) as f:
            f.write(np.ascontiguousarray(a).tobytes())
        if fs.get_file_info(final).type == pafs.FileType.NotFound:
            fs.move(aside, final)
        else:
            fs.delete_file(aside)


@dataclass
class Model:
    """What a worker needs beside the arrays; its size is the ranges' number."""
    folder: str
    tokens: int
    vocabulary: int
    starts: list[int]                               # word number at which each word range starts
    pair_ranges: int
    kinds: int = 0                                  # distinct pairs
    texts: int = 0
    pair_d: tuple = (0.0, 0.0, 0.0)
    word_d: tuple = (0.0, 0.0, 0.0)
    word_n: tuple = (0, 0, 0)                       # words with one, two, more predecessors
    begin: tuple = (0, 0, 0)                        # the begin's followers seen once, twice, more
    word_ranges: int = 1

    def words(self, h: np.ndarray) -> np.ndarray:
        """The numbers of word hashes (any order), UNKNOWN if not seen."""
        order = np.argsort(h)
        out, q = np.full(len(h), UNKNOWN, np.uint64), h[order]
        cut = np.searchsorted(range_of(q, self.word_ranges), np.arange(self.word_ranges + 1, dtype=np.uint64))
        for r in range(self.word_ranges):
            a, z = cut[r], cut[r + 1]
            if a < z:
                known = array(posixpath.join(self.folder, f"w{r}.0"), "<u8")
                if len(known):
                    at = np.minimum(np.searchsorted(known, q[a:z]), len(known) - 1)
                    hit = known[at] == q[a:z]
                    out[order[a:z][hit]] = (at[hit] + self.starts[r]).astype(np.uint64)
        return out

    def column(self, ids: np.ndarray, name: str, kind: str) -> np.ndarray:
        """A per-word value for word numbers; 0 for UNKNOWN."""
        out = np.zeros(len(ids), np.int64)
        order = np.argsort(ids)
        q = ids[order]
        cut = np.searchsorted(q, np.array([*self.starts, self.vocabulary], np.uint64))
        for r in range(self.word_ranges):
            a, z = cut[r], cut[r + 1]
            if a < z:
                out[order[a:z]] = array(posixpath.join(self.folder, f"{name.format(r)}"), kind)[
                    (q[a:z] - np.uint64(self.starts[r])).astype(np.int64)]
        return out

    def pair_counts(self, h: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair hashes."""
        out = np.zeros(len(h), np.int64)
        cut = np.searchsorted(range_of(h, self.pair_ranges), np.arange(self.pair_ranges + 1, dtype=np.uint64))
        for r in range(self.pair_ranges):
            a, z = cut[r], cut[r + 1]
            if a < z:
                known, small, big, counts = (array(posixpath.join(self.folder, f"p{r}.{i}"), k)
                                             for i, k in enumerate(("<u8", "u1", "<u8", "<i8")))
                if len(known):
                    at = np.minimum(np.searchsorted(known, h[a:z]), len(known) - 1)
                    found = np.where(known[at] == h[a:z], small[at].astype(np.int64), 0)
                    for i in np.flatnonzero(found == 255):
                        found[i] = counts[np.searchsorted(big, h[a + i])]
                    out[a:z] = found
        return out


# ------------------------------------------------------------------ counting


def in_training(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(MOD)) != HELD, F.lit(True))


def merge_ranges(rows: DataFrame, ranges: int, finish, schema: str) -> DataFrame:
    """One task for each range: the blobs of all tasks, merged, then
    ``finish(range, keys, sums)`` gives that range's record batch."""
    kinds = [f.name for f in rows.schema.fields if f.name != "part"]

    def run(batches):
        part, tally = None, Tally()
        for b in batches:
            for i in range(b.num_rows):
                part = b.column(b.schema.get_field_index("part"))[i].as_py()
                raw = [b.column(b.schema.get_field_index(k))[i].as_buffer() for k in kinds]
                keys = np.frombuffer(raw[0], "<u8")
                tally.add(keys, *(np.frombuffer(x, f"<u{len(x) // len(keys)}" if len(x) // len(keys) > 1 else "u1"
                                                ).astype(np.int64) for x in raw[1:]))
        if part is not None:
            yield finish(part, *tally.done())

    return rows.repartitionById(ranges, "part").mapInArrow(run, schema)


def narrow(values: np.ndarray) -> str:
    """The smallest unsigned kind that holds the values."""
    top = int(values.max()) if len(values) else 0
    return "u1" if top < 256 else "<u2" if top < 65536 else "<u4" if top < 1 << 32 else "<u8"


def count_words(texts: DataFrame, folder: str, ranges: int) -> DataFrame:
    def run(batches):
        tally, n = Tally(), 0
        for part in parts_of(batches, 0):
            words, code, offs = tokens(part.column(0))
            n += part.num_rows
            if len(words):
                tally.add(hash_words(words), np.bincount(code, minlength=len(words)))
        if n:
            tally.add(np.array([END]), np.array([n], np.int64))
            keys, (counts,) = tally.done()
            yield blobs(keys, [counts], range_of(keys, ranges), ranges, ["<u8", narrow(counts)])

    def finish(part, keys, sums):
        store(folder, f"w{part}", keys, sums[0].astype("<i8"))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()),
                                           pa.array([int(sums[0].sum())], pa.int64())], ["part", "n", "total"])

    rows = texts.mapInArrow(run, "part int, b0 binary, b1 binary")
    return merge_ranges(rows, ranges, finish, "part int, n long, total long")


def count_pairs(texts: DataFrame, model: Model, ranges: int) -> DataFrame:
    """Writes the pair arrays; returns the per-word sums, packed by word range,
    with each range's counts of counts beside them."""
    edges = np.array([*model.starts[1:], model.vocabulary], np.uint64)

    def run(batches):
        tally = Tally()
        end = model.words(np.array([END]))[0]
        for part in parts_of(batches, 0):
            words, code, offs = tokens(part.column(0))
            ids, own = with_ends(model.words(hash_words(words))[code] if len(code) else np.zeros(0, np.uint64), offs, end)
            k, n = np.unique(mix64(pairs(ids, own)), return_counts=True)
            tally.add(k, n)
        if tally.keys:
            keys, (counts,) = tally.done()
            yield blobs(keys, [counts], range_of(keys, ranges), ranges, ["<u8", narrow(counts)])

    def finish(part, keys, sums):
        c = sums[0]
        big = c >= 255
        store(model.folder, f"p{part}", keys, np.minimum(c, 255).astype("u1"), keys[big], c[big].astype("<i8"))
        plain = unmix64(keys)
        prev, cur = plain >> np.uint64(32), plain & np.uint64(0xFFFFFFFF)
        # per word: distinct predecessors; followers seen once, twice, more often
        one = np.ones(len(c), np.int64)
        zero = np.zeros(len(c), np.int64)
        ids, v = merged([cur, prev], [[one, zero], [zero, (c == 1).astype(np.int64)], [zero, (c == 2).astype(np.int64)],
                                      [zero, (c > 2).astype(np.int64)]])
        if len(ids) and ids[-1] == BEGIN:            # the begin's own followers
            begin, ids, v = [int(x[-1]) for x in v[1:]], ids[:-1], [x[:-1] for x in v]
        else:
            begin = [0, 0, 0]
        where = np.searchsorted(edges, ids, "right").astype(np.uint64)
        out = blobs(ids, v, where, len(edges), ["<u8", *map(narrow, v)])
        head = [len(keys), *(int((c == k).sum()) for k in (1, 2, 3, 4)), *begin]
        info = pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.array(head, "<i8").tobytes()], pa.binary()),
                                           *(pa.array([b""], pa.binary()) for _ in range(4))], out.schema.names)
        return pa.Table.from_batches([info, out]).combine_chunks().to_batches()[0]

    rows = texts.mapInArrow(run, "part int, b0 binary, b1 binary")
    return merge_ranges(rows, ranges, finish, "part int, b0 binary, b1 binary, b2 binary, b3 binary, b4 binary")


def store_word_sums(sums: DataFrame, model: Model) -> DataFrame:
    def finish(part, ids, v):
        n = [*model.starts, model.vocabulary][part + 1] - model.starts[part]
        at = (ids - np.uint64(model.starts[part])).astype(np.int64)
        full = []
        for x in v:
            f = np.zeros(n, "<i8")
            f[at] = x
            full.append(f)
        store(model.folder, f"f{part}", *full)
        before = full[0]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(
            pa.array([int((before == k).sum())], pa.int64()) for k in (1, 2, 3, 4)), pa.array([int((before > 2).sum())], pa.int64())],
            ["part", "n1", "n2", "n3", "n4", "more"])

    return merge_ranges(sums, model.word_ranges, finish, "part int, n1 long, n2 long, n3 long, n4 long, more long")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts for counts of one, two and more; a
    count of counts of zero leaves its estimate out."""
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d2 = 2 - 3 * y * n3 / n2
    return (1 - 2 * y * n2 / n1, min(2.0, max(0.0, d2)), min(3.0, max(0.0, 3 - 4 * y * n4 / n3)) if n3 else max(0.0, d2))


def fit(spark: SparkSession, docs: DataFrame, range_tokens: int = RANGE_TOKENS) -> Model:
    """Counts the training documents and stores the model's arrays."""
    texts = docs.where(in_training(F.col("doc_id"))).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()["c"]
    ranges = max(1, math.ceil(size / 6 / range_tokens))
    folder = scratch_path(spark, "ngram")
    made = {r["part"]: r for r in count_words(texts, folder, ranges).collect()}    # a row for each range
    starts, at = [], 0
    for r in range(ranges):
        starts.append(at)
        at += made[r]["n"] if r in made else 0
    model = Model(folder, sum(r["total"] for r in made.values()), at, starts, 1, word_ranges=ranges)
    if not at:
        return model
    for r in set(range(ranges)) - set(made):
        store(folder, f"w{r}", np.zeros(0, "<u8"), np.zeros(0, "<i8"))
    model.pair_ranges = max(1, math.ceil(model.tokens / range_tokens))
    sums = settle(spark, count_pairs(texts, model, model.pair_ranges), "ngram-sums")
    heads = [(np.frombuffer(r["b0"], "<i8")) for r in sums.where("part = -1").select("b0").collect()]
    total = np.sum(heads, axis=0)
    model.kinds = int(total[0])
    model.pair_d = discounts(*map(int, total[1:5]))
    begin = total[5:8]
    rows = store_word_sums(sums.where("part >= 0"), model).collect()
    n1, n2, n3, n4, more = (sum(r[k] for r in rows) for k in ("n1", "n2", "n3", "n4", "more"))
    model.word_d, model.word_n = discounts(n1, n2, n3, n4), (n1, n2, more)
    model.texts = int(model.column(model.words(np.array([END])), "w{}.1", "<i8")[0])
    model.begin = tuple(int(x) for x in begin)
    return model


# ------------------------------------------------------------------- scoring


def discounted(count: np.ndarray, d: tuple) -> np.ndarray:
    return count - np.where(count == 0, 0.0, np.where(count == 1, d[0], np.where(count == 2, d[1], d[2])))


def log10_probabilities(model: Model, word: np.ndarray, ids: np.ndarray, own: np.ndarray, unique: np.ndarray) -> np.ndarray:
    """log10 P of every token.  ``unique`` are the batch's distinct word
    numbers, ``word`` the place of each token in it, ``ids`` its number."""
    v = model.vocabulary
    g0 = sum(d * n for d, n in zip(model.word_d, model.word_n)) / model.kinds
    lower = discounted(model.column(unique, "f{}.0", "<i8"), model.word_d) / model.kinds + g0 / (v + 1)
    total = model.column(unique, "w{}.1", "<i8")
    spread = sum(d * model.column(unique, f"f{{}}.{i + 1}", "<i8") for i, d in enumerate(model.pair_d))
    seen = total > 0
    gamma = np.ones(len(unique))
    gamma[seen] = spread[seen] / total[seen]
    # one more context: the begin of a text
    total = np.append(total, model.texts)
    gamma = np.append(gamma, sum(d * n for d, n in zip(model.pair_d, model.begin)) / max(1, model.texts))
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[own[:-1]] = len(unique)
    keys, back = np.unique(mix64(pairs(ids, own)), return_inverse=True)
    high = discounted(model.pair_counts(keys), model.pair_d)[back]
    return np.log10(np.where(total[context] > 0, high / np.maximum(1, total[context]), 0.0)
                    + np.where(total[context] > 0, gamma[context], 1.0) * lower[word])


def score(spark: SparkSession, docs: DataFrame, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    model = fit(spark, docs, range_tokens)

    def run(batches):
        for b in parts_of(batches, 2):
            words, code, offs = tokens(b.column(2))
            n = b.num_rows
            h = np.append(hash_words(words), END)
            word, own = with_ends(code, offs, len(words))
            if model.vocabulary:
                unique = model.words(h)
                count = model.column(unique, "w{}.1", "<i8")
                logp = log10_probabilities(model, word, unique[word], own, unique)
            else:
                count, logp = np.zeros(len(h), np.int64), np.zeros(len(word))
            base = np.log10((count + 1) / (model.tokens + 1 * (model.vocabulary + 1)))[word]
            at = own[:-1]
            cols = [own[1:] - own[:-1], np.add.reduceat((count > 0)[word].astype(np.int64), at),
                    np.full(n, model.tokens, np.int64), np.add.reduceat(base, at), np.add.reduceat(logp, at)] if n else [
                np.zeros(0, np.int64)] * 3 + [np.zeros(0)] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, cols)],
                                             ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~in_training(F.col("doc_id"))).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
