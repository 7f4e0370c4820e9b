"""Operator 13: repair of the structure of conversations by an auction.

A conversation should be ``(s?(ua)+)?``: a system row if any, then user and
assistant rows in turn.  Its rows and the places in that pattern span a lattice
of nodes (rows used, place); an edit is an arc with a whole-number cost:

    Keep 0, Rerole to user or assistant 2, Delete 3, Insert an empty row 2;
    a truncated row that stays adds 1; blank and duplicate rows must go.

The cheapest edits are a shortest path, found by the auction algorithm
(``auction``): nodes have prices that never exceed any arc's cost plus the price
behind it; a path from the start is extended along an arc that meets this with
equality, or its last node's price is raised and the path contracted.  At the
end every cheapest path consists of tight arcs only; the one with the least
letters is traced along tight arcs that lead to the end.  The lattice is taken in
blocks of ``BLOCK`` rows from the end, the exact prices at a block's entry being
the fixed prices of the block before: the work stays linear in the rows, where
one auction over all would be quadratic in a long damaged conversation.

Scale.  Places in a conversation come from the chunked scan, so no task sorts a
whole conversation; first rows of equal text are found by a partial aggregate
and met again by (conversation, place), which is unique: no hot key.  For the
auction a conversation is one letter a row, gathered in parts of ``PART`` rows
and then joined, as long as the string of edits that is asked for.  The texts
meet their edits by (conversation, place).  Only the hash of a repaired
conversation reads its rows in one task, one after another, sorted by Spark: a
hash of one string has to; it holds one batch.

Results for odd input: nulls read as one space, except that a null turn comes
first in order and is no turn for ``gaps``; a null conversation id is one
conversation, returned as null; rows of one turn go by a hash of role and text,
the copies of a repeated row adjacent; repeated rows are duplicates; a
conversation whose rows were all dropped has zeros, no edits and the hash of
nothing; an empty table gives an empty result; other columns are not read; long
texts are only hashed and searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import settle
from streamops.plans.scan import Agg, chunk_for, prefix_scan

#: Rows of a block of the lattice, and of a part of a conversation's letters.
BLOCK = 16
PART = 1 << 16
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: Row classes by role initial (s, u, a, other) and faults, in the order of the row's letter.
ROLES = "sua"
FINE, BLANK, DUPLICATE, CUT = range(4)
LETTERS = "ABCDEFGHIJKLMNOP"
#: Places: before all, after system, after user, after assistant; where the next row must be a user's.
USER_NEXT = (0, 1, 3)
#: Prices after the last row: the cost of rows to be inserted to end after an assistant's.
END = [0, 4, 2, 0]


def _arcs(role: int, fault: int, place: int) -> list[tuple[str, int, int, int]]:
    """(letter, rows used, next place, cost) of a row's edits, by letter."""
    nxt = 2 if place in USER_NEXT else 3
    out = [("D", 1, place, DELETE), ("I", 0, nxt, INSERT)]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if role == 0 and place == 0:
            out.append(("K", 1, 1, extra))
        if role == nxt - 1:
            out.append(("K", 1, nxt, extra))
        out.append(("R", 1, nxt, REROLE + extra))
    return out


ARCS = {ord(LETTERS[4 * r + f]): [_arcs(r, f, p) for p in range(4)] for r in range(4) for f in range(4)}


def prices(codes: bytes, block: int = BLOCK) -> list[int]:
    """Prices of the nodes 4 * row + place, exact at the start (node 0) and at
    the edges of blocks, elsewhere at most the true cost to the end."""
    n = len(codes)
    price = [0] * (4 * n) + END
    for lo in range((n - 1) // block * block, -1, -block):
        hi = min(n, lo + block)
        least = min(price[4 * hi:4 * hi + 4])
        for node in range(4 * lo, 4 * hi):
            price[node] = least
        for start in range(4 * lo, 4 * lo + (4 if lo else 1)):
            path = [start]
            while path[-1] < 4 * hi:
                node = path[-1]
                row, place = divmod(node, 4)
                best, to = None, 0
                for _, used, nxt, cost in ARCS[codes[row]][place]:
                    there = 4 * (row + used) + nxt
                    if best is None or cost + price[there] < best:
                        best, to = cost + price[there], there
                if price[node] < best:                 # raise the price, contract the path
                    price[node] = best
                    if len(path) > 1:
                        path.pop()
                else:                                  # a tight arc: extend the path
                    path.append(to)
    return price


def auction(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """The cost of the cheapest edits, and their letters, the least of all."""
    n, price = len(codes), prices(codes, block)
    leads = bytearray(4 * n + 4)                       # nodes from which tight arcs reach the end
    leads[4 * n], leads[4 * n + 3] = 1, 1
    leads[4 * n + 1] = leads[4 * n + 2] = 1
    for row in range(n - 1, -1, -1):
        for used in (1, 0, 0, 0):                      # an insert leads to a node of the same row
            for place in range(4):
                node = 4 * row + place
                if not leads[node]:
                    leads[node] = any(u == used and leads[4 * (row + u) + nxt] and price[node] == cost + price[4 * (row + u) + nxt]
                                      for _, u, nxt, cost in ARCS[codes[row]][place])
    row, place, out = 0, 0, []
    while row < n or price[4 * n + place]:
        node = 4 * row + place
        arcs = ARCS[codes[row]][place] if row < n else [("I", 0, 2 if place in USER_NEXT else 3, INSERT)]
        for letter, used, nxt, cost in arcs:
            there = 4 * (row + used) + nxt
            if leads[there] and price[node] == cost + price[there]:
                out.append(letter)
                row, place = row + used, nxt
                break
    return price[0], "".join(out)


def key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """k, turn, role, text, copy: the rows with faults put in, by a hash of
    conversation and turn (0 drops, 1 empties, 2 strips ends, 3 repeats, 4 makes
    a user's row of twenty)."""
    c = conversations.select(key("conv_id").alias("k"), F.col("turn").cast("long").alias("turn"), key("role").alias("role"),
                             key("text").alias("text"), F.pmod(F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))), F.lit(20)).alias("c"))
    text = F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return c.where(F.col("c") != 0).select("k", "turn", F.when(F.col("c") == 4, "user").otherwise(F.col("role")).alias("role"),
                                           text.alias("text"), F.explode(copies).alias("copy"))


def placed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """k, turn, role, text, pos: the row's place (1, 2, ...) in its
    conversation; written, so that each later step sees the same places."""
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    out = prefix_scan(rows, ["k"], ["turn", "tie", "copy"], chunk_for(rows, "turn"), [Agg("pos", "count", F.lit(1))])
    return settle(spark, out.select("k", "turn", "role", "text", "pos"), "conversations")


def lettered(rows: DataFrame) -> DataFrame:
    """k, pos, letter: a row's role class and first fault as one letter."""
    same = rows.groupBy("k", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"))
    first = same.agg(F.min("pos").alias("pos")).select("k", "pos", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == ROLES[0], 0).when(initial == ROLES[1], 1).when(initial == ROLES[2], 2).otherwise(3)
    fault = (F.when(~F.col("some"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ends"), CUT).otherwise(FINE))
    flags = rows.select("k", "pos", role.alias("r"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("some"),
                        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("ends"))
    return flags.join(first, ["k", "pos"], "left").select(
        "k", "pos", F.substring(F.lit(LETTERS), F.col("r") * 4 + fault + 1, F.lit(1)).alias("letter"))


def strings(letters: DataFrame) -> DataFrame:
    """k, codes: a conversation's letters in order."""
    part = ((F.col("pos") - 1) / PART).cast("long")
    parts = letters.groupBy("k", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", "letter"))).alias("l"))
    parts = parts.select("k", "part", F.array_join(F.col("l.letter"), "").alias("codes"))
    whole = parts.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("l"))
    return whole.select("k", F.array_join(F.col("l.codes"), "").alias("codes"))


def solve(codes: DataFrame) -> DataFrame:
    """k, blank, duplicate, truncated, illegal, cost, audit."""
    fine = np.zeros((4, 4), bool)                      # pairs of role classes that may follow each other
    fine[0, 1] = fine[1, 2] = fine[2, 1] = True

    def rows(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out = []
            for c in b.column("codes").to_pylist():
                each = np.frombuffer(c.encode(), np.uint8) - ord(LETTERS[0])
                role, faults = each >> 2, np.bincount(each & 3, minlength=4)
                cost, audit = auction(c.encode())
                out.append((*faults[1:].tolist(), int((~fine[role[:-1], role[1:]]).sum()), cost, audit))
            cols = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), *(pa.array(x, pa.int64()) for x in cols[:5]), pa.array(cols[5], pa.string())],
                names=["k", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return codes.mapInArrow(rows, "k string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _edits(solved: DataFrame) -> DataFrame:
    """k, at, pos, new_role: the rows of the repaired conversation.  ``pos`` is
    the row it comes from, null for an inserted one; ``new_role`` is null where
    the role stays."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            ks, ats, poss, news = [], [], [], []
            for k, audit, first in zip(b.column("k").to_pylist(), b.column("audit").to_pylist(), b.column("system").to_pylist()):
                pos = at = place = 0
                for letter in audit:
                    pos += letter != "I"
                    if letter == "D":
                        continue
                    at += 1
                    if letter == "K" and place == 0 and pos == first:
                        place, new = 1, None
                    else:
                        place = 2 if place in USER_NEXT else 3
                        new = None if letter == "K" else ("user" if place == 2 else "assistant")
                    ks.append(k)
                    ats.append(at)
                    poss.append(None if letter == "I" else pos)
                    news.append(new)
                    if len(ks) == PART:
                        yield batch(ks, ats, poss, news)
                        ks, ats, poss, news = [], [], [], []
            yield batch(ks, ats, poss, news)

    def batch(ks, ats, poss, news):
        return pa.RecordBatch.from_arrays([pa.array(ks, pa.string()), pa.array(ats, pa.int64()), pa.array(poss, pa.int64()),
                                           pa.array(news, pa.string())], names=["k", "at", "pos", "new_role"])

    return solved.mapInArrow(rows, "k string, at long, pos long, new_role string")


def repaired(rows: DataFrame, solved: DataFrame, letters: DataFrame) -> DataFrame:
    """k, at, role, text: the repaired conversations' rows in order ``at``."""
    # a kept system row can only be the first that stays; its class tells it from a kept user's row
    kept_first = F.length(F.regexp_extract("audit", "^D*", 0)) + 1
    firsts = solved.select("k", "audit", kept_first.cast("long").alias("pos")).join(
        letters.where(F.col("letter").isin(*LETTERS[:4])), ["k", "pos"], "left")
    edits = _edits(firsts.select("k", "audit", F.when(F.col("letter").isNotNull(), F.col("pos")).alias("system")))
    inserted = edits.where(F.col("pos").isNull()).select("k", "at", F.col("new_role").alias("role"), F.lit("").alias("text"))
    stay = edits.where(F.col("pos").isNotNull()).join(rows.select("k", "pos", "role", "text"), ["k", "pos"])
    return stay.select("k", "at", F.coalesce("new_role", "role").alias("role"), "text").unionByName(inserted)


def digests(rows: DataFrame) -> DataFrame:
    """k, repaired_sha256: of ``role:text`` joined by newlines, in order."""

    def hashes(batches: Iterator[pa.RecordBatch]):
        last, h = None, None
        for b in batches:
            done = []
            for k, line in zip(b.column("k").to_pylist(), b.column("line").to_pylist()):
                if k == last:
                    h.update(b"\n")
                else:
                    if last is not None:
                        done.append((last, h.hexdigest()))
                    last, h = k, hashlib.sha256()
                h.update(line.encode())
            yield batch(done)
        yield batch([(last, h.hexdigest())] if last is not None else [])

    def batch(done):
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)],
                                          names=["k", "repaired_sha256"])

    ordered = rows.repartition("k").sortWithinPartitions("k", "at").select("k", F.concat("role", F.lit(":"), "text").alias("line"))
    return ordered.mapInArrow(hashes, "k string, repaired_sha256 string")


def repair(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summaries, rows) of conversations given as k, turn, role, text, copy:
    k, gaps, blank, duplicate, truncated, illegal, cost, audit for each, and
    the repaired rows k, at, role, text."""
    rows = placed(spark, rows)
    letters = settle(spark, lettered(rows), "letters")
    solved = settle(spark, solve(strings(letters)), "edits")
    turns = rows.groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy("k").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    return solved.join(turns, "k"), repaired(rows, solved, letters)


def audit(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row for each conversation of the table, after ``damage``."""
    summaries, rows = repair(spark, damage(conversations))
    ids = conversations.select(key("conv_id").alias("k")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    back = F.when(F.col("k") != " ", F.col("k")).cast(conversations.schema["conv_id"].dataType)
    return ids.join(summaries, "k", "left").join(digests(rows), "k", "left").select(
        back.alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
