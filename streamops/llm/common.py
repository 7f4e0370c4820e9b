"""Helpers shared by the operators of this package."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.session import scratch_path
from streamops.sources.tables import read_table

__all__ = ["as_text", "filesystem", "hash_words", "local_path", "mix", "read_table", "scratch_path", "settle",
           "sieve", "small_batches", "some_texts", "split_words",
           "with_text"]

# Odd multipliers for mixing 64-bit hashes (fixed values of this package).
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def settle(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, so a
    lost executor costs no recomputation, and every later step sees one fixed
    set of rows."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch sent to a Python worker.
BATCH = 1 << 21


def small_batches(spark: SparkSession) -> None:
    """Rows go to the Python workers in batches of about ``BATCH`` bytes.  Spark's
    own bounds, 10,000 rows and 64 MB, let a task hold tens of megabytes of text
    in the JVM and again in the worker.  The setting stays with the session, for
    the rows move only when the result is used."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


#: Bits of a sieve, 4 MB whatever the size of its table, and of one piece of it:
#: as many as Spark's bitmaps hold.
SIEVE = 1 << 25
PIECE = 1 << 15


def sieve(spark: SparkSession, rows: DataFrame, few: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose keys are surely not in ``few``, and the
    others, which a join has to tell apart.  A bitmap of the keys' hashes; the
    more keys, the more rows it doubts, and the result of the join is the same.
    The bitmap's pieces are a table of their own, broadcast to the rows."""
    at = F.xxhash64(*keys).bitwiseAND(F.lit(SIEVE - 1))
    piece, bit = F.expr(f"_at div {PIECE}"), F.expr(f"_at % {PIECE}")
    hashed = few.select(at.alias("_at")).select(piece.alias("_piece"), bit.alias("_bit"))
    # dealt by piece first, so that no task but a piece's own holds any of it; at most SIEVE / PIECE rows
    marks = settle(spark, hashed.repartition("_piece").groupBy("_piece").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")), "sieve")
    octet = f"conv(hex(substring(_bits, int(_at % {PIECE} div 8) + 1, 1)), 16, 10)"
    marked = F.coalesce(F.expr(f"getbit(int({octet}), int(_at % 8)) = 1"), F.lit(False))
    seen = rows.withColumn("_at", at).withColumn("_of", piece).join(
        F.broadcast(marks), F.col("_of") == F.col("_piece"), "left").withColumn("_marked", marked)
    mine = ("_at", "_of", "_piece", "_bits", "_marked")
    return seen.where(~F.col("_marked")).drop(*mine), seen.where("_marked").drop(*mine)


def with_text(docs: DataFrame, row: Column, text: Column, changed: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, with another text
    where ``changed``; n_chars, where there is one, follows the text."""
    out = []
    for f in docs.schema.fields:
        c = row.getField(f.name)
        if f.name == "text":
            c = F.when(changed, text).otherwise(c)
        elif f.name == "n_chars":
            c = F.when(changed, F.length(text).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return out


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and inner path of a shared-folder URI or plain path."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return pafs.LocalFileSystem(), local_path(uri)
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def local_path(uri: str) -> str:
    return unquote(urlparse(uri).path) if uri.startswith("file:") else uri


def as_text(col) -> pa.Array:
    """A string array without nulls (null reads as empty), one chunk."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.string()) if not pa.types.is_string(col.type) else col
    return pc.fill_null(col, "")


def some_texts(col, chars: int = 1 << 23):
    """The texts of a batch in runs of at most 50,000 and about ``chars`` bytes."""
    texts = as_text(col)
    at = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))))
    a = 0
    while a < len(texts):
        z = int(np.searchsorted(at, at[a] + chars, "left"))
        z = min(len(texts), max(a + 1, z), a + 50_000)
        yield a, texts.slice(a, z - a)
        a = z


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """White-space words ``[^\\x20\\x09-\\x0D]+`` of each text.

    Returns (distinct words, the code of every word, word offsets per text)."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offs = lists.flatten(), lists.offsets.to_numpy()
    offs = offs - offs[0]
    keep = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not keep.all():
        kept_before = np.concatenate(([0], np.cumsum(keep)))
        offs, flat = kept_before[offs], flat.filter(pa.array(keep))
    d = flat.dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False).astype(np.int64), offs.astype(np.int64)


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * MIX
    x = x ^ (x >> np.uint64(29))
    x = x * MIX2
    return x ^ (x >> np.uint64(32))
