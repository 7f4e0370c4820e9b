"""Near-duplicate classes by improved consistent weighted sampling.

Texts are weighted sets of five-word shingles (one shingle of all words if
there are fewer), weight = term frequency x inverse document frequency.  Each
text gives SAMPLES consistent weighted samples, BANDS bands of them; texts that
share a band are compared with the bucket's leader by exact weighted Jaccard
similarity, and links of 0.8 or more make classes (connected components).

* Equal texts are one node (their MD5), so copies are never compared.
* The document frequency of a shingle counts families (texts with the same
  smallest shingle hash) rather than texts: a thousand near copies of one text
  do not make its shingles common.  Frequencies below FLOOR of all documents
  count as FLOOR, so only shingles above it need a table, and at most
  (mean shingles per text) / FLOOR of them can exist: a bound that does not grow
  with the corpus.  They are found exactly: a shingle in at least FLOOR of all
  documents is in at least FLOOR / 2 of some block's, or its sum over the blocks
  that report it would be below half of the floor; what passes that sum is
  counted anew over all documents.
* A bucket's members are compared with one leader.  Those outside the bucket's
  largest class afterwards are compared with LEADERS of it; this only makes the
  classes large at little cost.  What is left is exact: see ``rest``.
* Before vectors are moved, a pair has to pass a bound that is never too small:
  each text's weights summed over few slots of its shingles (``outlines``).
* The draws (r, c, beta) of a sample are functions of a hash of (shingle, sample).

Everything between the steps is a table in the shared folder; buckets, links
and classes never pass through the driver.

Defined results: a null text reads as empty; texts without words are linked
only to equal texts; class_id is the smallest doc_id of the class (null if all
are null); repeated rows are copies; an empty table gives no rows; other columns
are ignored (kept by ``dedupe``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import hash_words, mix, settle, sieve, small_batches, some_texts, split_words
from streamops.llm.components import components, salted_join

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 10, 2
SAMPLES = BANDS * ROWS
FLOOR = 0.01
LEADERS = 4                      # of a bucket's largest class, in the further round
STEPS = 4                        # of an outline's slot for one shingle of full weight
FULL = 255                       # a slot with this much or more
PART = 1 << 21                   # bytes of text in hand at a time, each a dozen arrays of its words
BLOCK = 4_000_000                # shingles of one block of the frequency count
BITS = np.uint64(48)
MASK = np.uint64((1 << 48) - 1)
FACTOR = np.uint64(0x100000001B3)

#: Quantiles of the exponential distribution, by 16 bits of a hash; the sum of
#: two is a Gamma(2, 1) draw.
EXPONENTIAL = -np.log((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
_rng = np.random.default_rng(20240229)
ODD = (_rng.integers(0, 1 << 63, SAMPLES).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


# ---------------------------------------------------------------- shingles


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes of each text in order, their term
    frequencies, and the offsets of the texts."""
    n = len(texts)
    words, code, offs = split_words(pc.ascii_lower(texts))
    stream = hash_words(words)[code] if len(code) else np.zeros(0, np.uint64)
    size = np.diff(offs)
    width = len(stream) - SHINGLE + 1
    parts = []
    if width > 0:
        h = np.zeros(width, np.uint64)
        for k in range(SHINGLE):
            h = h * FACTOR + stream[k:k + width]
        row = np.repeat(np.arange(n), size)[:width]
        inside = np.arange(width) + SHINGLE <= offs[1:][row]
        parts.append((row[inside].astype(np.uint64) << BITS) | (mix(h[inside]) & MASK))
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        one = np.zeros(len(short), np.uint64)
        for i, r in enumerate(short):
            x = size[r:r + 1].astype(np.uint64)
            for k in range(offs[r], offs[r + 1]):
                x = mix(x * FACTOR + stream[k:k + 1])
            one[i] = x[0]
        parts.append((short.astype(np.uint64) << BITS) | (one & MASK))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    key = np.sort(np.concatenate(parts))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    tf = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & MASK, tf, np.searchsorted(key >> BITS, np.arange(n + 1, dtype=np.uint64))


# ------------------------------------------------------ common shingles


def often_in_blocks(texts: DataFrame, share: float) -> DataFrame:
    """(h, n): shingles in at least ``share`` of a block's texts, with their
    number of texts there; a row with h = -1 for the texts of all blocks."""

    def report(blocks, rows):
        h, n = np.unique(np.concatenate(blocks) if blocks else np.zeros(0, np.uint64), return_counts=True)
        keep = n >= share * rows
        return pa.RecordBatch.from_arrays([pa.array(np.append(h[keep].astype(np.int64), -1)),
                                           pa.array(np.append(n[keep].astype(np.int64), rows))], ["h", "n"])

    def run(batches):
        blocks, rows, size = [], 0, 0
        for b in batches:
            for _, part in some_texts(b.column(0), PART):
                h, _, _ = shingles(part)
                blocks.append(h)
                rows, size = rows + len(part), size + len(h)
                if size >= BLOCK:
                    yield report(blocks, rows)
                    blocks, rows, size = [], 0, 0
        if rows:
            yield report(blocks, rows)

    return texts.mapInArrow(run, "h long, n long")


def common_shingles(spark: SparkSession, docs: DataFrame, floor: float = FLOOR) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of documents, sorted common shingles, their family frequency)."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sums = settle(spark, often_in_blocks(texts, floor / 2).groupBy("h").agg(F.sum("n").alias("n")), "often")
    total = sums.where("h = -1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    # at most 2 / floor * (mean shingles per text) rows pass
    maybe = np.array(sorted(r["h"] for r in sums.where((F.col("h") >= 0) & (F.col("n") >= floor * total / 2)).select(
        "h").collect()), np.uint64)
    if not len(maybe):
        return total, maybe, np.zeros(0, np.int64)
    wanted = spark.sparkContext.broadcast(maybe)

    def run(batches):
        seen = np.zeros((0, 2), np.uint64)
        for b in batches:
            for _, part in some_texts(b.column(0), PART):
                h, _, offs = shingles(part)
                size = np.diff(offs)
                some = size > 0
                family = np.repeat(h[offs[:-1][some]], size[some])
                hit = np.isin(h, wanted.value)
                seen = np.unique(np.concatenate((seen, np.stack((h[hit], family[hit]), 1))), axis=0)
                if len(seen) > BLOCK // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(seen[:, i].astype(np.int64)) for i in (0, 1)], ["h", "family"])
                    seen = seen[:0]
        yield pa.RecordBatch.from_arrays([pa.array(seen[:, i].astype(np.int64)) for i in (0, 1)], ["h", "family"])

    exact = texts.mapInArrow(run, "h long, family long").distinct().groupBy("h").agg(F.count("*").alias("n"))
    rows = exact.where(F.col("n") >= floor * total).collect()
    rows.sort(key=lambda r: r["h"])
    return total, np.array([r["h"] for r in rows], np.uint64), np.array([r["n"] for r in rows], np.int64)


def weights(h: np.ndarray, tf: np.ndarray, common: tuple[int, np.ndarray, np.ndarray], floor: float = FLOOR) -> np.ndarray:
    """Term frequency x ln(1 + documents / document frequency)."""
    total, known, n = common
    idf = np.full(len(h), np.log1p(1 / floor))
    if len(known) and len(h):
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = known[at] == h
        idf[hit] = np.log1p(total / np.maximum(n[at[hit]], floor * total))
    return tf * idf


# --------------------------------------------------------------- sampling


def samples(h: np.ndarray, weight: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """SAMPLES consistent weighted samples of each non-empty text, as hashes of
    (shingle, t): ln y = r (t - beta) with t = floor(ln w / r + beta); the
    smallest ln c - ln y - r is sampled, ties by the smaller shingle hash."""
    log_w = np.log(weight).astype(np.float32)
    at, size = offs[:-1], np.diff(offs)
    owner = np.repeat(np.arange(len(size)), size)
    out = np.empty((len(size), SAMPLES), np.uint64)
    for j in range(SAMPLES):
        x = mix(h * ODD[j])
        bits = x.view(np.uint16).reshape(-1, 4)
        c = EXPONENTIAL[bits[:, 0]] + EXPONENTIAL[bits[:, 1]]
        r = EXPONENTIAL[bits[:, 2]] + EXPONENTIAL[bits[:, 3]]
        beta = ((x * ODD[0]) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
        t = np.floor(log_w / r + beta)
        a = np.log(c) - r * (t - beta + 1)
        least = np.minimum.reduceat(a, at)
        hit = np.flatnonzero(a == least[owner])
        _, first = np.unique(owner[hit], return_index=True)
        pick = hit[first]                               # shingles are in order within a text
        out[:, j] = mix(h[pick] * FACTOR + t[pick].astype(np.int64).astype(np.uint64))
    return out


def bands(sample: np.ndarray) -> np.ndarray:
    out = np.empty((len(sample), BANDS), np.uint64)
    for b in range(BANDS):
        x = np.full(len(sample), b + 1, np.uint64)
        for j in range(b * ROWS, (b + 1) * ROWS):
            x = mix(x * FACTOR + sample[:, j])
        out[:, b] = x
    return out


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """node, doc_id, text: the node is the MD5 of the whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.unhex(F.md5(text.cast("binary"))).alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
                       text.alias("text"), *more)


def outlines(h: np.ndarray, weight: np.ndarray, offs: np.ndarray) -> pa.Array:
    """One byte for each slot of a text: the weight of its shingles there, in
    steps and rounded up.  The slots are the low bits of the hashes, a power of
    two that gives each two to four shingles, so that outlines of two lengths
    are compared by adding up the longer."""
    size = np.maximum(np.diff(offs), 1)
    slots = 1 << np.maximum(np.log2(size).astype(np.int64) - 1, 3)
    ends = np.concatenate(([0], np.cumsum(slots)))
    owner = np.repeat(np.arange(len(size)), np.diff(offs))
    at = ends[owner] + (h & (slots[owner] - 1).astype(np.uint64)).astype(np.int64)
    sums = np.bincount(at, weight, int(ends[-1])) * (STEPS / np.log1p(1 / FLOOR))
    raw = np.minimum(np.ceil(sums - 1e-9), FULL).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])


def most_shared(a: bytes, b: bytes) -> float:
    """At least the weight that two texts of these outlines share."""
    x, y = (np.frombuffer(o, np.uint8).astype(np.int64) for o in ((a, b) if len(a) >= len(b) else (b, a)))
    x, y = np.where(x == FULL, 1 << 40, x), np.where(y == FULL, 1 << 40, y)
    return float(np.minimum(x.reshape(-1, len(y)).sum(0), y).sum() * np.log1p(1 / FLOOR) / STEPS)


def sketch(spark: SparkSession, docs: DataFrame, common) -> DataFrame:
    """node, doc_id, band hashes (none for a text without words), weight and
    outline of every row."""
    shared = spark.sparkContext.broadcast(common)

    def run(batches):
        for b in batches:
            for a, part in some_texts(b.column(2), PART):
                h, tf, offs = shingles(part)
                full = np.diff(offs) > 0
                lists, w = np.zeros((0, BANDS), np.uint64), weights(h, tf, shared.value)
                if full.any():
                    lists = bands(samples(h, w, np.append(offs[:-1][full], offs[-1])))
                ends = np.concatenate(([0], np.cumsum(full * BANDS))).astype(np.int32)
                col = pa.ListArray.from_arrays(pa.array(ends), pa.array(lists.reshape(-1).astype(np.int64)))
                owner = np.repeat(np.arange(len(part)), np.diff(offs))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, len(part)), b.column(1).slice(a, len(part)), col,
                     pa.array(np.bincount(owner, w, len(part)).astype(float)), outlines(h, w, offs)],
                    ["node", "doc_id", "bands", "whole", "outline"])

    return settle(spark, keyed(docs).mapInArrow(
        run, "node binary, doc_id long, bands array<long>, whole double, outline binary"), "sketch")


# ---------------------------------------------------------- links and classes


def similarity(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard of two texts given by sorted shingles and weights."""
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    hit = hb[at] == ha
    both = np.minimum(wa[hit], wb[at[hit]]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def vectors(spark: SparkSession, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, h, tf of the texts of ``nodes`` (node, doc_id: one of its rows)."""

    def run(batches):
        for b in batches:
            for a, part in some_texts(b.column(1), PART):
                h, tf, offs = shingles(part)
                small = h.astype("<u8")
                rows = range(len(part))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, len(part)),
                     pa.array([packed(small[offs[i]:offs[i + 1]]) for i in rows], pa.binary()),
                     pa.array([counts(tf[offs[i]:offs[i + 1]]) for i in rows], pa.binary())],
                    ["node", "h", "tf"])

    # most texts are in no bucket: those that surely aren't are not moved
    _, some = sieve(spark, keyed(docs), nodes, ["node", "doc_id"])
    texts = some.join(nodes.hint("merge"), ["node", "doc_id"]).select("node", "text").dropDuplicates(["node"])
    return settle(spark, texts.mapInArrow(run, "node binary, h binary, tf binary"), "vectors")


def counts(tf: np.ndarray) -> bytes:
    """Term frequencies in one byte each, or four where one needs them."""
    return tf.astype("<u4" if len(tf) and tf.max() > 255 else "u1").tobytes()


def uncounted(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "u1" if len(raw) == n else "<u4")


def packed(h: np.ndarray) -> bytes:
    """The 6 low bytes of each 48-bit hash."""
    return h.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def possible(spark: SparkSession, pairs: DataFrame, light: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose outlines (``light``: node, whole, outline) leave the bound possible."""
    near = 1 - 1e-6                                     # for rounding

    def run(batches):
        for b in batches:
            oa, ob = (b.column(b.schema.get_field_index(c)) for c in ("oa", "ob"))
            both = np.array([most_shared(x.as_py(), y.as_py()) for x, y in zip(oa, ob)], np.float64)
            total = b.column(b.schema.get_field_index("total")).to_numpy(zero_copy_only=False)
            mask = pa.array(both * (1 + similar) >= near * similar * total)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)).filter(mask) for c in ("a", "b")], ["a", "b"])

    la = light.select(F.col("node").alias("a"), F.col("whole").alias("wa"), F.col("outline").alias("oa"))
    lb = light.select(F.col("node").alias("b"), F.col("whole").alias("wb"), F.col("outline").alias("ob"))
    both = pairs.join(la, "a").join(lb, "b").where(F.least("wa", "wb") >= near * similar * F.greatest("wa", "wb"))
    both = both.select("a", "b", (F.col("wa") + F.col("wb")).alias("total"), "oa", "ob")
    return settle(spark, both.mapInArrow(run, "a binary, b binary"), "possible")


def verified(spark: SparkSession, pairs: DataFrame, vecs: DataFrame, common, similar: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the bound."""
    shared = spark.sparkContext.broadcast(common)

    def run(batches):
        for b in batches:
            keep, sims = [], []
            cols = [b.column(b.schema.get_field_index(c)) for c in ("ha", "ta", "hb", "tb")]
            for i in range(b.num_rows):
                ha, ta, hb, tb = (c[i].as_py() for c in cols)
                ha, hb = unpacked(ha), unpacked(hb)
                s = similarity(ha, weights(ha, uncounted(ta, len(ha)), shared.value),
                               hb, weights(hb, uncounted(tb, len(hb)), shared.value))
                keep.append(s >= similar)
                sims.append(s)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("a")).filter(mask), b.column(b.schema.get_field_index("b")).filter(mask),
                 pa.array(sims, pa.float64()).filter(mask)], ["a", "b", "similarity"])

    # only the vectors that the pairs need are moved; a leader's pairs are the
    # large side of an inner join, which Spark splits where it is skewed
    left = vecs.select(F.col("node").alias("a"), F.col("h").alias("ha"), F.col("tf").alias("ta")).join(
        pairs.select("a").distinct(), "a", "left_semi")
    right = vecs.select(F.col("node").alias("b"), F.col("h").alias("hb"), F.col("tf").alias("tb")).join(
        pairs.select("b").distinct(), "b", "left_semi")
    both = pairs.join(left, "a").join(right, "b")
    return settle(spark, both.mapInArrow(run, "a binary, b binary, similarity double"), "verified")


def buckets(sketches: DataFrame) -> DataFrame:
    """(band, node) of distinct texts, for bands that two or more share."""
    nodes = sketches.groupBy("node").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))
    each = nodes.select("node", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    return salted_join(each, shared, ["band"])


def classes(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(node, doc_id, label) of every row: the label is the class's smallest
    node, null for a text in no class but its own.

    Columns node and label are MD5 sums of texts."""
    small_batches(spark)
    common = common_shingles(spark, docs)
    sketches = sketch(spark, docs, common)
    member = settle(spark, buckets(sketches), "buckets")
    light = settle(spark, sketches.join(member.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("whole").alias("whole"), F.first("outline").alias("outline")), "light")
    leaders = member.groupBy("band").agg(F.min("node").alias("b"))
    pairs = salted_join(member, leaders, ["band"]).where("node != b").select(
        F.col("node").alias("a"), "b").distinct()
    pairs = possible(spark, pairs, light, similar)
    need = light.select("node", "doc_id")
    vecs = vectors(spark, docs.where("doc_id is not null"), need.where("doc_id is not null"))
    if docs.where("doc_id is null").limit(1).count():
        vecs = vecs.unionByName(unnamed_vectors(spark, docs, need.where("doc_id is null").select("node")))
    labels = components(spark, verified(spark, pairs, vecs, common, similar))
    more = possible(spark, across(member, labels).join(pairs, ["a", "b"], "left_anti"), light, similar)
    if more.limit(1).count():
        new = verified(spark, more, vecs, common, similar)
        pairs = settle(spark, pairs.unionByName(more), "pairs")
        if new.limit(1).count():
            labels = joined_labels(spark, labels, new)
    last = possible(spark, rest(spark, member, labels, light, vecs, common, similar), light, similar)
    last = settle(spark, last.join(pairs, ["a", "b"], "left_anti"), "pairs")
    if last.limit(1).count():
        new = verified(spark, last, vecs, common, similar)
        if new.limit(1).count():
            labels = joined_labels(spark, labels, new)
    return salted_join(sketches.select("node", "doc_id"), labels, ["node"], "left")


def across(member: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): members of buckets that hold several classes, with LEADERS of
    the bucket's largest class (chosen by a hash) where they are of another.

    Only buckets of which that class is a tenth: the members of others have
    a passage in common rather than a source."""
    now = salted_join(member, labels, ["node"], "left").withColumn("label", F.coalesce("label", "node"))
    lead = F.array(*(F.min_by("node", F.xxhash64("band", "node", F.lit(i))) for i in range(LEADERS)))
    each = now.groupBy("band", "label").agg(F.count("*").alias("n"), F.array_distinct(lead).alias("leaders"))
    main = each.groupBy("band").agg(F.sum("n").alias("n"), F.count("*").alias("classes"), F.max("n").alias("top"), F.max_by(
        F.struct(F.col("label").alias("own"), "leaders"), "n").alias("m")).where("classes > 1 and top > 1 and 10 * top >= n")
    others = salted_join(now, main.select("band", "m.*"), ["band"]).where("label != own")
    return others.select("node", F.explode("leaders").alias("b")).select(
        F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()


def prefix(n: np.ndarray, h: np.ndarray, w: np.ndarray, whole: float, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """The first of a text's shingles ``h`` that other texts hold too, rarest
    (``n``) first and then by hash, up to where less than ``similar`` of its
    weight is left; and the weight left from each on.  Two texts as similar
    share one of their first shingles: else all that they share is in the left
    weight of one of them."""
    order = np.lexsort((h, n))
    left = np.cumsum(w[order][::-1])[::-1]
    k = int((left >= similar * whole * (1 - 1e-9)).sum())
    return h[order[:k]], left[:k]


def rest(spark: SparkSession, member: DataFrame, labels: DataFrame, light: DataFrame, vecs: DataFrame, common,
         similar: float) -> DataFrame:
    """(a, b): every pair of different classes that can reach ``similar``, of
    texts from buckets that hold several classes beside their first leader.

    A prefix filter, lossless for weighted Jaccard similarity: shingles that
    few of these texts hold come first, so neither a passage that many share nor
    what near copies keep of their source is a reason to compare them.  Pairs are
    dropped only where the weights left from a shared shingle on are too small
    for the bound.  Of a shingle's texts those outside its largest class meet all
    others, so at most as many pairs within classes are looked at as between them."""
    shared = spark.sparkContext.broadcast(common)
    now = salted_join(member, labels, ["node"], "left").withColumn("label", F.coalesce("label", "node"))
    leaders = member.groupBy("band").agg(F.min("node").alias("b"))
    others = salted_join(now, leaders, ["band"]).where("node != b")
    mixed = others.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("band")
    of = settle(spark, salted_join(others, mixed, ["band"]).select("node", "label").distinct().join(
        light.select("node", "whole"), "node"), "mixed")

    def single(batches):
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in ("node", "h", "tf")}
            for i in range(0, b.num_rows, 1000):
                raw = [unpacked(x.as_py()) for x in col["h"].slice(i, 1000)]
                w = [weights(h, uncounted(x.as_py(), len(h)), shared.value) for h, x in zip(raw, col["tf"].slice(i, 1000))]
                row = pa.array(np.repeat(np.arange(len(raw)), [len(h) for h in raw]))
                yield pa.RecordBatch.from_arrays(
                    [col["node"].slice(i, 1000).take(row), pa.array(np.concatenate(raw).astype(np.int64)),
                     pa.array(np.concatenate(w))], ["node", "h", "w"])

    def first(batches):
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in ("node", "label", "whole", "list")}
            key, left, size = [], [], []
            for own, whole in zip(col["list"], col["whole"]):
                n, h, w = (own.values.field(c).to_numpy(zero_copy_only=False) for c in ("n", "h", "w"))
                k, after = prefix(n, h, w, whole.as_py(), similar)
                key.append(k)
                left.append(after)
                size.append(len(k))
            if not size:
                continue
            row = pa.array(np.repeat(np.arange(len(size)), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key)), col["node"].take(row), col["label"].take(row), col["whole"].take(row),
                 pa.array(np.concatenate(left))], ["key", "a", "label", "whole", "rest"])

    parts = settle(spark, of.select("node").join(vecs, "node").mapInArrow(single, "node binary, h long, w double"), "shingles")
    often = parts.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    lists = parts.join(often, "h").groupBy("node").agg(F.collect_list(F.struct("n", "h", "w")).alias("list"))
    each = settle(spark, lists.join(of, "node").mapInArrow(
        first, "key long, a binary, label binary, whole double, rest double"), "prefixes")
    main = each.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max_by("label", "n").alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
    few = each.join(main, "key").where("label != main").select(
        "key", F.col("a").alias("b"), F.col("label").alias("lb"), F.col("whole").alias("wb"), F.col("rest").alias("rb"))
    near = 1 - 1e-6                                     # for rounding
    can = (F.least("rest", "rb") >= near * similar / (1 + similar) * (F.col("whole") + F.col("wb"))) & (
        F.least("whole", "wb") >= near * similar * F.greatest("whole", "wb"))
    return each.join(few, "key").where((F.col("label") != F.col("lb")) & can).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def joined_labels(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the classes that they join."""
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    new = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    known = settle(spark, labels.unionByName(new), "labels")
    la = known.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = known.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = links.select("a", "b").join(la, "a").join(lb, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    roots = components(spark, between).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return settle(spark, salted_join(known, roots, ["label"], "left").select(
        "node", F.coalesce("root", "label").alias("label")), "labels")


def unnamed_vectors(spark: SparkSession, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Vectors of texts all of whose rows have a null doc_id."""
    at = F.lit(-1).cast("long")
    return vectors(spark, docs.where("doc_id is null").select(at.alias("doc_id"), "text"), nodes.select("node", at.alias("doc_id")))


def near_duplicates(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id and class_size of every row."""
    rows = settle(spark, classes(spark, docs, similar).withColumn("label", F.coalesce("label", "node")), "classes")
    per = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return salted_join(rows, per, ["label"]).select("doc_id", "class_id", "class_size")


def dedupe(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One document of each class, the one with the smallest doc_id (nulls
    last); all columns are kept."""
    rows = settle(spark, classes(spark, docs, similar).withColumn("label", F.coalesce("label", "node")), "classes")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    keep = rows.groupBy("label").agg(F.min(first).alias("k")).select("k.node", "k.doc_id")
    # rows that repeat the kept one: usually none
    times = rows.groupBy("node", "doc_id").count()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keep = settle(spark, keep.withColumn("_key", key).join(times.withColumn("_key", key).drop("doc_id"), ["node", "_key"])
                  .select(F.col("node").alias("_node"), "_key", "count"), "kept")
    own = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    all_rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), own.alias("_node"), key.alias("_key"))
    # most rows are kept: only those that may go, or may be repeated, are moved
    seen = rows.select(F.col("node").alias("_node"), key.alias("_key")).distinct()
    sure, some = sieve(spark, all_rows, seen.join(keep.where("count = 1"), ["_node", "_key"], "left_anti"), ["_node", "_key"])
    single = some.join(keep.where("count = 1").drop("count").hint("merge"), ["_node", "_key"])
    again = some.join(keep.where("count > 1").drop("count").hint("merge"), ["_node", "_key"]).dropDuplicates(["_node", "_key"])
    return sure.unionByName(single).unionByName(again).select("_doc.*")
