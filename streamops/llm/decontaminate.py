"""Benchmark decontamination by greedy string tiling (running Karp-Rabin).

Tokens are white-space words in lower case, without punctuation at their ends.
The benchmark is read in blocks of a stated size; each block becomes an index
of Karp-Rabin hashes of its MIN_MATCH-token windows, sent to the tasks.  One
pass over the documents per block then joins their windows with the index and,
for every document and item with shared seeds, tiles the item: the longest
common runs of unmarked tokens are marked again and again, so passages that
were cut up and put in another order are covered too.  A document is
contaminated by an item when tiles cover at least ``COVERAGE`` of the item.

Items that could not reach the threshold even if every shared seed counted are
passed over; that bound is exact, so nothing is lost.  No shuffle is needed,
and neither the hits nor the documents go through the driver.

Defined results: null texts have no tokens; an item of fewer than MIN_MATCH
tokens contaminates nothing; repeated items count once, repeated documents once
each; an empty table on either side gives no pairs; other columns are ignored
(kept by ``remove``).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import mix, small_batches, some_texts, split_words

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_CHARS = 8_000_000
PART = 1 << 21                   # bytes of text in hand at a time, each a dozen arrays of its words
ENDS = re.compile(r"^[\W_]+|[\W_]+$")
FACTOR = np.uint64(0x100000001B3)


def token(word: str) -> str:
    return ENDS.sub("", word).lower()


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash of every run of ``size`` tokens."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x, h = mix(ids.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
    if size <= 16:
        for k in range(size):
            h = h * FACTOR + x[k:k + n]
        return h
    # h(i) = S(i + size) - S(i) * f^size, with S(i + 1) = S(i) * f + x(i)
    power, inverse = powers(len(x) + 1), powers(len(x) + 1, pow(int(FACTOR), -1, 1 << 64))
    s = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * inverse[:len(x)])))
    return (s[size:] - s[:n]) * power[size - 1:size - 1 + n]


def powers(n: int, base: int = int(FACTOR)) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out)


def common_runs(p: np.ndarray, t: np.ndarray, free_p: np.ndarray, free_t: np.ndarray,
                size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs (length, start in p, start in t) of at least
    ``size`` unmarked tokens."""
    def open_windows(ids, free):
        bad = np.concatenate(([0], np.cumsum(~free)))
        h = window_hashes(ids, size)
        at = np.flatnonzero(bad[size:] == bad[:len(h)]) if len(h) else np.zeros(0, np.int64)
        return h[at], at

    hp, ip = open_windows(p, free_p)
    ht, it = open_windows(t, free_t)
    if not len(hp) or not len(ht):
        return []
    order = np.argsort(hp, kind="stable")
    hp, ip = hp[order], ip[order]
    lo, hi = np.searchsorted(hp, ht, "left"), np.searchsorted(hp, ht, "right")
    n = hi - lo
    total = int(n.sum())
    if not total:
        return []
    j = np.repeat(it, n)
    i = ip[np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)]
    # only where the run cannot start one token earlier
    inner = (i > 0) & (j > 0)
    a, b = i[inner] - 1, j[inner] - 1
    inner[inner] = (p[a] == t[b]) & free_p[a] & free_t[b]
    out = []
    for x, y in zip(i[~inner].tolist(), j[~inner].tolist()):
        k, most = 0, min(len(p) - x, len(t) - y)
        while k < most and p[x + k] == t[y + k] and free_p[x + k] and free_t[y + k]:
            k += 1
        if k >= size:
            out.append((k, x, y))
    return out


def tile(p: np.ndarray, t: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of p by t: non-overlapping (length, start in p,
    start in t), the longest first.  Search lengths fall by halves, and rise to
    the longest run found, as in the running Karp-Rabin form."""
    free_p, free_t, tiles = np.ones(len(p), bool), np.ones(len(t), bool), []
    size = max(least, min(len(p), len(t)) // 2)
    while True:
        found = common_runs(p, t, free_p, free_t, size)
        longest = max((f[0] for f in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        marked = False
        for k, x, y in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if free_p[x:x + k].all() and free_t[y:y + k].all():
                free_p[x:x + k] = free_t[y:y + k] = False
                tiles.append((k, x, y))
                marked = True
        if marked:
            continue                                   # what was cut off by a mark may still hold a run
        if size == least:
            return tiles
        size = max(least, size // 2)


class Index:
    """One block of benchmark items: vocabulary, token ids, seed hashes."""

    def __init__(self, items: list[tuple[int, str]], least: int = MIN_MATCH):
        self.least, self.vocab, self.items = least, {}, []
        keys, owner = [], []
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in map(token, (text or "").split()) if w],
                           np.int64)
            if len(ids) < least:
                continue
            h = window_hashes(ids, least)
            owner.append(np.full(len(h), len(self.items)))
            keys.append(h)
            self.items.append((item_id, ids, h))
        k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        o = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.lexsort((o, k))
        self.keys, self.owner = k[order], o[order]

    def ids_of(self, words: pa.Array) -> np.ndarray:
        """Per distinct word its token id, -1 if no item has it, -2 if it is
        punctuation only (and no token)."""
        def one(w: str) -> int:
            w = token(w)
            return self.vocab.get(w, -1) if w else -2
        return np.fromiter((one(w) for w in words.to_pylist()), np.int64, len(words))

    def batch(self, texts: pa.Array, coverage: float):
        """(row, item, tiles) of the contaminated texts of a batch."""
        if not len(self.items):
            return
        words, code, offs = split_words(texts)
        ids = self.ids_of(words)[code] if len(code) else code
        real = ids != -2
        offs = np.concatenate(([0], np.cumsum(real)))[offs]
        ids = ids[real]
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        n = len(ids) - self.least + 1
        if n <= 0:
            return
        at = np.flatnonzero(known[self.least:] - known[:n] == self.least)
        if not len(at):
            return
        row = np.searchsorted(offs, at, "right") - 1
        inside = at + self.least <= offs[row + 1]
        at, row = at[inside], row[inside]
        h = np.zeros(len(at), np.uint64)
        for k in range(self.least):
            h = h * FACTOR + mix(ids[at + k].astype(np.uint64) + np.uint64(1))
        hit = np.isin(h, self.keys)
        at, row, h = at[hit], row[hit], h[hit]
        for r, first, count in zip(*np.unique(row, return_index=True, return_counts=True)):
            mine = np.unique(h[first:first + count])
            lo, hi = np.searchsorted(self.keys, mine, "left"), np.searchsorted(self.keys, mine, "right")
            own = np.unique(np.concatenate([self.owner[a:b] for a, b in zip(lo, hi)]))
            t = None
            for i in own.tolist():
                item_id, p, hp = self.items[i]
                starts = np.flatnonzero(np.isin(hp, mine))
                reach = np.zeros(len(p) + 1, np.int64)
                np.add.at(reach, starts, 1)
                np.add.at(reach, starts + self.least, -1)
                if (np.cumsum(reach[:-1]) > 0).sum() < coverage * len(p):
                    continue
                if t is None:
                    t = self.near(ids[offs[r]:offs[r + 1]], at[first:first + count] - offs[r])
                tiles = tile(p, t, self.least)
                if sum(x[0] for x in tiles) >= coverage * len(p):
                    yield int(r), item_id, len(p), tiles

    def near(self, t: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The text's tokens inside seed windows; every run of others becomes
        one token that matches nothing (tiles lie within seed windows)."""
        reach = np.zeros(len(t) + 1, np.int64)
        np.add.at(reach, starts, 1)
        np.add.at(reach, starts + self.least, -1)
        seen = np.cumsum(reach[:-1]) > 0
        edge = seen | np.concatenate(([True], seen[:-1]))
        return np.where(seen, t, -1)[edge]


def blocks(spark: SparkSession, benchmark: DataFrame, least: int = MIN_MATCH, block_chars: int = BLOCK_CHARS):
    """Broadcast indexes of the whole benchmark, each over about
    ``block_chars`` characters."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    size = b.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // block_chars))
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect() if size else []
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        yield spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in rows], least))


PAIRS = "doc_id long, item_id long, item_tokens int, matched int, n_tiles int, coverage double"


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                 least: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    small_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def search(index):
        def run(batches):
            for b in batches:
                rows = []
                for a, part in some_texts(b.column(1), PART):
                    for r, item, n, tiles in index.value.batch(part, coverage):
                        matched = sum(x[0] for x in tiles)
                        rows.append((b.column(0)[a + r].as_py(), item, n, matched, len(tiles), matched / n))
                cols = list(zip(*rows)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 [x.split()[0] for x in PAIRS.split(", ")])
        return d.mapInArrow(run, PAIRS)

    out = None
    for index in blocks(spark, benchmark, least, block_chars):
        part = search(index)
        out = part if out is None else out.unionByName(part)
    return out


def remove(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
           least: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without the contaminated ones, all columns kept."""
    small_batches(spark)
    at = docs.columns.index("text")

    def drop(index):
        def run(batches):
            for b in batches:
                for a, part in some_texts(b.column(at), PART):
                    keep = np.ones(len(part), bool)
                    for r, *_ in index.value.batch(part, coverage):
                        keep[r] = False
                    yield b.slice(a, len(part)).filter(pa.array(keep))
        return run

    for index in blocks(spark, benchmark, least, block_chars):
        docs = docs.mapInArrow(drop(index), docs.schema)
    return docs
