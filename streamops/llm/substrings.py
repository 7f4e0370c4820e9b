"""Operator 11: substring de-duplication by seed and extend.

Seeds are winnowed anchors.  Every run of ``SPAN`` words holds
``SPAN - SEED + 1`` seeds of ``SEED`` words; the one with the least hash is its
anchor, so equal runs have the same anchor at the same place.  The runs that an
anchor answers for start at neighbouring words; together they are the anchor's
*extent*, which reaches to both sides of the seed.

1. Documents meet on their anchors.  Where the whole extent is equal, the match
   extends over all of it: every document but the one with the smallest id
   holds a repeat there (``meet``).
2. Anchors that several different extents share are where a repeat begins or
   ends.  One document of each such extent is compared run by run, which is the
   extension word by word to the longest common part (``runs``).
3. Repeats that touch or overlap are joined: the maximal repeats of a document
   (``repeats``); ``removed`` drops their words.

A match is by 128 bits (seed and extent, seed and run).  No pairs of documents
are made: a group is judged by its smallest id.

Scale.  An anchor stands for about five words.  It crosses the network once, in
a row (anchor, extent, id) of which each part of a batch sends one for equal
extents; the rest is known there and then.  Groups are windows sorted on disk,
not lists.  A frequent anchor with many different extents would be one task:
``frequent`` finds every anchor with more than ``1 / SHARE`` of all rows (at
most ``2 * SHARE``, the bound of what is collected), and these are spread by
extent, all of them going on to step 2, so the result does not depend on which
anchors are found.  Texts are moved twice, by id.

Results for odd input: a null text is empty; a null id is no source and has
none, so its text stays whole; rows that share an id are one document (none is
another's source) though each gets its own row; ties do not arise, as ids
decide; texts under ``SPAN`` words have no repeats; an empty table gives an
empty result; other columns are not read.  A long text is handled whole, in
memory of its row (about 20 bytes a character while it is worked on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamops.llm.common import mix, settle, some_texts

#: Words of the shortest repeat, and of a seed.
SPAN = 13
SEED = 5
#: An anchor with more than one of so many rows is spread by extent.
SHARE = 10_000
#: Odd multiplier of the rolling hash and its inverse modulo 2^64.
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: White space (fixed values of the contract).
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes hashed at a time; words longer than ``LONG`` are hashed one by one.
SLICE = 1 << 20
LONG = 64
_POWER = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(SLICE, STEP, np.uint64))))
_BACK = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(SLICE, BACK, np.uint64))))


class Words:
    """The words of some texts: their bytes ``data[start:end]``, the first word
    of each text (``offsets``, one more at the end), and a hash of each."""

    def __init__(self, texts: pa.Array):
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        n = len(self.data)
        edge = np.zeros(n + 1, bool)                   # a text begins here
        edge[at] = True
        blank = np.concatenate(([True], SPACE[self.data], [True]))
        inside = ~blank[1:-1]
        self.start = np.flatnonzero(inside & (blank[:-2] | edge[:-1]))
        self.end = np.flatnonzero(inside & (blank[2:] | edge[1:])) + 1
        self.offsets = np.searchsorted(self.start, at)

    def hashes(self) -> np.ndarray:
        size = self.end - self.start
        out = np.zeros(len(size), np.uint64)
        a = 0
        while a < len(size):                           # some words at a time: powers of one table
            z = max(a + 1, int(np.searchsorted(self.start, self.start[a] + SLICE - LONG)))
            lo, hi = self.start[a], min(len(self.data), self.start[a] + SLICE)
            total = np.concatenate(([np.uint64(0)], np.cumsum((self.data[lo:hi].astype(np.uint64) + np.uint64(1)) * _POWER[:hi - lo], dtype=np.uint64)))
            s, e = self.start[a:z] - lo, np.minimum(self.end[a:z] - lo, hi - lo)
            out[a:z] = (total[e] - total[s]) * _BACK[s]
            a = z
        for i in np.flatnonzero(size > LONG):
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i]:self.end[i]])
        return mix(out + size.astype(np.uint64) * BACK)

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The words to keep of each text, joined by one space."""
        last = np.zeros(len(keep), bool)               # the last word kept of each text has no space after it
        kept = np.flatnonzero(keep)
        text = np.searchsorted(self.offsets, kept, "right")
        last[kept[np.append(text[1:] != text[:-1], True)[:len(kept)]]] = True
        depth = np.zeros(len(self.data) + 2, np.int8)
        depth[self.start[keep]] += 1
        depth[self.end[keep] + ~last[keep]] -= 1       # words never touch, a space lies between
        mask = np.cumsum(depth[:-2], dtype=np.int8) > 0
        data = self.data[mask]
        data[SPACE[data]] = 0x20
        size = np.concatenate(([0], np.cumsum((self.end - self.start + ~last) * keep)))
        return pa.Array.from_buffers(pa.large_string(), len(self.offsets) - 1, [
            None, pa.py_buffer(size[self.offsets].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class Anchors:
    """The anchors of some texts, as flat arrays in word order.

    text     the text of each anchor
    seed     hash of its seed
    first, last  its extent's runs start at words first..last (of all texts)
    extent   hash of the extent and of the seed's place in it
    run(i)   hashes of the runs that start at the words ``i``"""

    def __init__(self, texts: pa.Array, span: int = SPAN, seed: int = SEED):
        self.span = span
        self.words = Words(texts)
        self.offsets, h = self.words.offsets, self.words.hashes()
        n = len(h)
        power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, STEP, np.uint64))))
        self._back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, BACK, np.uint64))))
        self._sum = np.concatenate(([np.uint64(0)], np.add.accumulate(h * power[:n], dtype=np.uint64)))
        inside = np.diff(self.offsets)
        runs = np.maximum(inside - span + 1, 0)
        # starts of all runs, and the place of the least seed of each
        start = np.repeat(self.offsets[:-1] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        seeds = self._hash(np.arange(max(0, n - seed + 1)), seed)
        # least of 2, 4, 8, ... seeds, the first of equal ones, up to all of a run
        least, at, have, need = seeds, np.arange(len(seeds)), 1, span - seed + 1
        while have < need:
            by = min(have, need - have)
            less = least[by:] < least[:-by]
            least, at = np.where(less, least[by:], least[:-by]), np.where(less, at[by:], at[:-by])
            have += by
        least, at = least[start], at[start]
        owner = np.repeat(np.arange(len(inside)), runs)
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(start))[:len(head)] - 1
        self.text, self.seed = owner[head], least[head]
        self.first, self.last = start[head], start[tail]
        place = (at[head] - self.first).astype(np.uint64)
        self.extent = mix(self._hash(self.first, self.last - self.first + span) + (place + np.uint64(1)) * BACK)

    def _hash(self, a: np.ndarray, length) -> np.ndarray:
        return mix((self._sum[a + length] - self._sum[a]) * self._back[a])

    def run(self, i: np.ndarray) -> np.ndarray:
        return self._hash(i, self.span)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Anchors]]:
    """Batches in parts of some megabytes of text, with their anchors."""
    for b in batches:
        for a, texts in some_texts(b.column("text"), 1 << 22):
            yield b.slice(a, len(texts)), Anchors(texts)


def _first_of(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of one row with the smallest ``doc`` for each key, and of the
    rows with a greater one (rows that repeat a document's key go)."""
    order = np.lexsort((doc, *keys[::-1]))
    k = [x[order] for x in keys]
    new = np.ones(len(order), bool)
    again = np.zeros(len(order), bool)
    same = np.logical_and.reduce([x[1:] == x[:-1] for x in k])
    new[1:], again[1:] = ~same, same & (doc[order][1:] == doc[order][:-1])
    return order[new], order[~new & ~again]


def frequent(docs: DataFrame, share: int = SHARE) -> np.ndarray:
    """The anchors with more than ``1 / share`` of all rows; ``2 * share`` at most.

    A part sends the anchors that it holds twice or more and above half that
    share of its own rows; an anchor above the share in all has at least half of
    its rows above the half share in their parts.  What is found only decides
    where rows go, never what is repeated."""

    def count(batches):
        for _, a in _parts(batches):
            values, n = np.unique(a.seed, return_counts=True)
            often = (n * 2 * share >= len(a.seed)) & (n > 1)
            yield pa.RecordBatch.from_arrays(
                [_long(np.concatenate((values[often], np.zeros(1, np.uint64)))),
                 _long(np.concatenate((n[often], [0]))), _long(np.concatenate((np.zeros(often.sum(), np.int64), [len(a.seed)])))],
                names=["a", "n", "all"])

    each = docs.mapInArrow(count, "a long, n long, all long").groupBy("a").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))
    each = settle(docs.sparkSession, each, "frequent")
    total = each.agg(F.sum("all")).first()[0] or 0
    found = each.where(F.col("n") * 2 * share > total).select("a").collect()
    return np.array(sorted(r["a"] for r in found), np.int64)


def meet(docs: DataFrame, spread: np.ndarray) -> DataFrame:
    """(doc, e, known): ``known`` extents repeat a document with a smaller id;
    the others are the first of their kind, under an anchor that different
    extents share."""

    def rows(batches):
        for b, a in _parts(batches):
            doc = b.column("doc").to_numpy()[a.text]
            one, more = _first_of(doc, a.seed, a.extent)
            # equal extents of the part: all but the first are known here
            which = np.concatenate((one, more))
            known = np.arange(len(which)) >= len(one)
            seed, extent, doc = a.seed[which], a.extent[which], doc[which]
            to = np.where(known | np.isin(seed.view(np.int64), spread), extent ^ seed, seed)
            to = np.where(known, mix(to ^ doc.view(np.uint64)), to)
            for i in range(0, len(which), 100_000):
                s = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([_long(to[s]), _long(np.where(known, to, seed)[s]), _long(extent[s]), _long(doc[s]),
                                                  pa.array(known[s])], names=["to", "a", "e", "doc", "known"])

    each = docs.mapInArrow(rows, "to long, a long, e long, doc long, known boolean")
    # one exchange and one sort: by "to", which is the anchor unless it is spread
    inner = Window.partitionBy("to", "a", "e").orderBy("doc").rowsBetween(Window.unboundedPreceding, 0)
    anchor = Window.partitionBy("to", "a").orderBy("e", "doc")
    each = each.repartition("to").withColumn("least", F.min("doc").over(inner)).withColumn(
        "other", F.first("e").over(anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        != F.last("e").over(anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    later = F.col("known") | (F.col("doc") > F.col("least"))
    return each.where(later | F.col("other") | (F.col("to") != F.col("a"))).select("doc", "e", later.alias("known"))


def runs(docs: DataFrame, met: DataFrame) -> DataFrame:
    """(doc, r): runs under the extents to be compared that a document with a
    smaller id has too."""
    lists = met.where(~F.col("known")).groupBy("doc").agg(F.collect_set("e").alias("e"))

    def rows(batches):
        for b, a in _parts(batches):
            wanted = b.column("e")
            has = np.zeros(len(a.extent), bool)
            for t in np.unique(a.text):
                mine = slice(*np.searchsorted(a.text, [t, t + 1]))
                has[mine] = np.isin(a.extent[mine].view(np.int64), wanted[int(t)].values.to_numpy())
            at = np.flatnonzero(has)
            n = a.last[at] - a.first[at] + 1
            start = np.repeat(a.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            seed, run = np.repeat(a.seed[at], n), a.run(start)
            doc = b.column("doc").to_numpy()[np.repeat(a.text[at], n)]
            one, more = _first_of(doc, seed, run)
            which = np.concatenate((one, more))
            known = np.arange(len(which)) >= len(one)
            seed, run, doc = seed[which], run[which], doc[which]
            seed = np.where(known, mix(run ^ doc.view(np.uint64)), seed)
            for i in range(0, len(which), 100_000):
                s = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([_long(seed[s]), _long(run[s]), _long(doc[s]), pa.array(known[s])],
                                                 names=["a", "r", "doc", "known"])

    each = docs.join(lists, "doc").mapInArrow(rows, "a long, r long, doc long, known boolean")
    first = Window.partitionBy("a", "r").orderBy("doc").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("least", F.min("doc").over(first))
    return each.where(F.col("known") | (F.col("doc") > F.col("least"))).select("doc", "r")


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _covered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc, text, e, r): every row with its repeated extents and runs (hashes)."""
    d = _prepared(docs)
    known = d.where(F.col("doc").isNotNull())
    met = settle(spark, meet(known, frequent(known)), "substrings")
    single = settle(spark, runs(known, met), "runs")
    both = met.where("known").select("doc", "e", F.lit(None).cast("long").alias("r")).unionByName(
        single.select("doc", F.lit(None).cast("long").alias("e"), "r"))
    lists = both.groupBy("doc").agg(F.collect_set("e").alias("e"), F.collect_set("r").alias("r"))
    return d.join(lists, "doc", "left")


def _lists(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a part with repeats, their extents and runs."""
    e, r = b.column("e"), b.column("r")
    for t in np.flatnonzero(e.is_valid().to_numpy(zero_copy_only=False)):
        yield int(t), e[t].values.to_numpy(), r[t].values.to_numpy()


def _spans(a: Anchors, t: int, e: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal repeats of text ``t``, in words of the text."""
    lo, hi = int(a.offsets[t]), int(a.offsets[t + 1])
    cover = np.zeros(hi - lo + 1, np.int64)
    mine = slice(*np.searchsorted(a.text, [t, t + 1]))
    if len(e):
        hit = np.isin(a.extent[mine].view(np.int64), e)
        np.add.at(cover, a.first[mine][hit] - lo, 1)
        np.add.at(cover, a.last[mine][hit] + a.span - lo, -1)
    if len(r):
        start = np.arange(lo, hi - a.span + 1)
        start = start[np.isin(a.run(start).view(np.int64), r)] - lo
        np.add.at(cover, start, 1)
        np.add.at(cover, start + a.span, -1)
    inside = np.concatenate(([False], np.cumsum(cover)[:-1] > 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The maximal repeats: (doc_id, start, n_words), one row for each longest
    run of words of a document that documents with smaller ids cover."""

    def rows(batches):
        for b, a in _parts(batches):
            doc, start, n = [], [], []
            for t, e, r in _lists(b):
                s, z = _spans(a, t, e, r)
                doc += [b.column("doc")[t].as_py()] * len(s)
                start += s.tolist()
                n += (z - s).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, n)], names=["doc_id", "start", "n_words"])

    return _covered(spark, docs).mapInArrow(rows, "doc_id long, start long, n_words long")


def removed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, kept (the
    words left, joined by one space) and kept_sha256."""

    def rows(batches):
        for b, a in _parts(batches):
            keep = np.ones(a.offsets[-1], bool)
            for t, e, r in _lists(b):
                for s, z in zip(*_spans(a, t, e, r)):
                    keep[a.offsets[t] + s:a.offsets[t] + z] = False
            left = np.concatenate(([0], np.cumsum(keep)))[a.offsets]
            n, kept = np.diff(a.offsets), a.words.joined(keep)
            digests = [hashlib.sha256(x.as_buffer()).hexdigest() for x in kept]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(n, pa.int64()), pa.array(n - np.diff(left), pa.int64()), kept.cast(pa.string()),
                 pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return _covered(spark, docs).mapInArrow(
        rows, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
