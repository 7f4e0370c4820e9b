"""Best-fit packing of token sequences by exact-complement hashing.

Every document becomes its token ids and one end id; longer ones are cut into
``capacity``-token pieces, the first one taking the odd remainder.  Piece
lengths are at most ``capacity``, so the *plan* is made on a histogram of at
most ``capacity`` counts, whatever the number of documents: for each length,
largest first, an index of the lengths still available gives the single, the
pair or the triple that fills the gap exactly, and the combination is used as
often as its scarcest member allows.  What is left goes best-fit, longest
first.  Pieces then find their place by their rank among pieces of equal
length, computed from per-partition counts, so no length class is gathered in
one task.

Defined results: a null text is empty and packs as the end id alone; an empty
table gives no rows; rows repeated in the input are packed once each; other
columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamops.llm.common import settle, small_batches, some_texts

CAPACITY = 1024
END_ID = 2
PART = 1 << 21                   # bytes of text in hand at a time, each a dozen arrays of its words and ids

# ---------------------------------------------------------------- token ids


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """A byte-pair encoder over a rank file (``<base64> <rank>`` lines)."""
    import base64

    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_batch(enc, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and the offsets of each text.

    The pre-tokenizer never joins a non-space to the white space after it, so
    where single spaces separate non-space pieces the ids of a text are the
    ids of its ``" piece"`` units in a row.  Distinct units are encoded once a
    batch; texts with other spacing are encoded whole."""
    lists = pc.split_pattern(texts, " ")
    flat, offs = lists.flatten(), lists.offsets.to_numpy()
    offs = (offs - offs[0]).astype(np.int64)
    d = flat.dictionary_encode()
    code, units = d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()
    ids = [enc.encode_ordinary(" " + u) for u in units]
    odd = np.fromiter((not u or u[0].isspace() or u[-1].isspace() for u in units), bool, len(units))
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    pool = np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum()))
    del ids
    at = np.concatenate(([0], np.cumsum(n)))[:-1]
    size, begin = n[code], at[code]
    size[offs[:-1]] = 0                                # a text's first piece has no space before it
    flags = np.concatenate(([0], np.cumsum(odd[code])))
    whole = flags[offs[1:]] > flags[offs[:-1]]
    ends = np.concatenate(([0], np.cumsum(size)))
    total = int(ends[-1])
    rest = pool[np.repeat(begin - ends[:-1], size) + np.arange(total)] if total else pool[:0]
    out, lengths = [], []
    for i in range(len(texts)):
        a, b = offs[i], offs[i + 1]
        if whole[i]:
            part = [np.array(enc.encode_ordinary(texts[i].as_py()), np.uint32)]
        else:
            part = [np.array(enc.encode_ordinary(units[code[a]]), np.uint32), rest[ends[a]:ends[b]]]
        out += part
        lengths.append(sum(map(len, part)))
    return (np.concatenate(out) if out else pool[:0]), np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids),
    with the partition it was made in and its rank there among its length."""
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
              + (", ids array<int>" if with_ids else ""))

    def run(batches):
        enc, part, seen = encoder(path, pattern), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for keys, texts in ((b.column(0).slice(a, len(t)).to_pylist(), t)
                            for b in batches for a, t in some_texts(b.column(1), PART)):
            ids, offs = encode_batch(enc, texts)
            rows = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids")}
            for i, key in enumerate(keys):
                own = np.append(ids[offs[i]:offs[i + 1]], np.uint32(end_id)).astype("<u4")
                n = len(own)
                cut = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for j, (a, z) in enumerate(zip(cut, cut[1:])):
                    rows["doc_id"].append(key)
                    rows["piece"].append(j)
                    rows["start"].append(a)
                    rows["length"].append(z - a)
                    rows["ids_crc32"].append(zlib.crc32(own[a:z].tobytes()))
                    rows["part"].append(part)
                    rows["nth"].append(int(seen[z - a]))
                    if with_ids:
                        rows["ids"].append(own[a:z].astype(np.int32))
                    seen[z - a] += 1
            cols = [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()),
                    *(pa.array(rows[k], pa.int64()) for k in ("start", "length", "ids_crc32")),
                    pa.array(rows["part"], pa.int32()), pa.array(rows["nth"], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                cols.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- the plan


def fill_exactly(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths with sum ``gap``, longest first."""
    def single(g: int):
        return (g,) if g > 0 and left[g] > 0 else None

    def pair(g: int, most: int):
        b = np.arange(min(most, g - 1), (g + 1) // 2 - 1, -1)
        if not len(b):
            return None
        ok = (left[b] > 0) & (left[g - b] > (2 * b == g))
        return (int(b[ok.argmax()]), int(g - b[ok.argmax()])) if ok.any() else None

    if gap <= 0:
        return None
    if found := single(gap) or pair(gap, gap - 1):
        return found
    for b in np.flatnonzero(left[:gap])[::-1]:
        b = int(b)
        if 3 * b < gap:
            break
        left[b] -= 1
        found = pair(gap - b, b)
        left[b] += 1
        if found:
            return (b, *found)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns of (length, repeats) runs and how many sequences follow each."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    out: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def use(lengths: list[int]) -> None:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        times = min(int(left[x]) // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= times * k
        out.append((tuple(sorted(need.items(), reverse=True)), times))

    if left[capacity]:
        use([capacity])
    for a in range(capacity - 1, 0, -1):
        while left[a] > 0:
            left[a] -= 1
            found = fill_exactly(left, capacity - a)
            left[a] += 1
            if not found:
                break
            use([a, *found])
    # best fit for the rest: bins of equal content are kept together with a count
    gaps: dict[int, list[list]] = {}
    for a in range(capacity, 0, -1):
        n = int(left[a])
        while n:
            fit = min((g for g in gaps if g >= a), default=None)
            if fit is None:
                per = capacity // a
                for times, k in ((n // per, per), (1, n % per)):
                    if times and k:
                        gaps.setdefault(capacity - k * a, []).append([((a, k),), times])
                break
            have = gaps[fit]
            runs, bins = have[-1]
            k = min(fit // a, -(-n // bins))           # copies of this length for each of these bins
            took = min(bins, n // k)
            n -= took * k
            gaps.setdefault(fit - k * a, []).append([(*runs, (a, k)), took])
            if took == bins:
                have.remove(next(x for x in have if x[0] is runs))
                if not have:
                    del gaps[fit]
            else:
                next(x for x in have if x[0] is runs)[1] -= took
    out += [(runs, times) for group in gaps.values() for runs, times in group]
    return out


def segments(patterns, capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset, repeats): the
    pieces of that length from the first rank on fill those sequences."""
    used, base, rows = {}, 0, {}
    for runs, times in patterns:
        offset = 0
        for length, k in runs:
            first = used.get(length, 0)
            rows.setdefault(length, []).append((first, base, offset, k))
            used[length] = first + times * k
            offset += length * k
        base += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def place(length: np.ndarray, rank: np.ndarray, table: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for n in np.unique(length):
        at = length == n
        t, r = table[int(n)], rank[at]
        s = t[np.searchsorted(t[:, 0], r, side="right") - 1]
        k = r - s[:, 0]
        seq[at], off[at] = s[:, 1] + k // s[:, 3], s[:, 2] + (k % s[:, 3]) * n
    return seq, off


def pack(spark: SparkSession, docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence_id and offset; see the module's text.

    ``path`` is the rank file of the tokenizer, ``pattern`` its pre-tokenizer
    pattern.  ``with_ids`` keeps the token ids of each piece."""
    small_batches(spark)
    cut = settle(spark, pieces(docs, path, pattern, capacity, end_id, with_ids), "pieces")
    per = cut.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    hist = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = segments(plan(hist, capacity), capacity)
    ranked = cut.join(first, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
        (F.col("first") + F.col("nth")).alias("rank"))
    names = [c for c in ranked.columns if c != "rank"]

    def run(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            seq, off = place(length, rank, table)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(seq), pa.array(off)],
                [*names, "sequence_id", "offset"])

    kind = {"piece": "int", "ids": "array<int>"}
    placed = ranked.mapInArrow(run, ", ".join(f"{c} {kind.get(c, 'long')}" for c in names)
                               + ", sequence_id long, offset long")
    return placed.coalesce(max(1, cut.rdd.getNumPartitions()))     # as many as the pieces were read in
