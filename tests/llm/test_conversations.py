"""Conversation repair against dynamic programming over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from streamops.llm import conversations as C
from tests.conftest import SF001
from tests.llm.fixtures import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
SOME = re.compile(r"[^\x20\x09-\x0D]")
INF = (1 << 60, "")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = SOME.findall(text)
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by the best suffix of every (row, place)."""
    kinds, n = faults(rows), len(rows)
    nxt = {0: 2, 1: 2, 3: 2, 2: 3}
    best = {(n, 0): (0, "", []), (n, 3): (0, "", [])}
    for i in range(n, -1, -1):
        here = {p: [best[n, p]] if (n, p) in best and i == n else [] for p in range(4)}
        if i < n:
            role, text = rows[i]
            for p in range(4):
                opts = here[p]
                c, a, r = best[i + 1, p]
                opts.append((c + 3, "D" + a, r))
                if kinds[i] in ("", "truncated"):
                    extra = kinds[i] == "truncated"
                    for to, initial in ((1, "s"), (2, "u"), (3, "a")):
                        if role[:1] == initial and (p == 0 if to == 1 else nxt[p] == to):
                            c, a, r = best[i + 1, to]
                            opts.append((c + extra, "K" + a, [(role, text)] + r))
                    c, a, r = best[i + 1, nxt[p]]
                    opts.append((c + 2 + extra, "R" + a, [("user" if nxt[p] == 2 else "assistant", text)] + r))
        for _ in range(4):                             # inserts stay at the row
            for p in range(4):
                if here[nxt[p]]:
                    c, a, r = min(here[nxt[p]], key=lambda x: x[:2])
                    here[p].append((c + 2, "I" + a, [("user" if nxt[p] == 2 else "assistant", "")] + r))
        for p in range(4):
            best[i, p] = min(here[p], key=lambda x: x[:2])
    return best[0, 0]


def damaged(table):
    out = defaultdict(list)
    for conv, turn, role, text in table:
        c = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv]
        if c == 0:
            continue
        text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
        role = "user" if c == 4 else role
        out[conv] += [(turn, role, text)] * (2 if c == 3 else 1)
    return out


def brute(table):
    want = {}
    for conv, rows in damaged(table).items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [(r, x) for _, r, x in rows]
        kinds = faults(pairs)
        cost, audit, fixed = cheapest(pairs) if pairs else (0, "", [])
        want[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in fixed).encode()).hexdigest()}
    return want


def check(spark, table, df=None):
    got = rows_of(C.audit(spark, df if df is not None else spark.createDataFrame(table, SCHEMA)))
    want = brute(table)
    assert len(got) == len(want)
    for r in got:
        conv = r.pop("conv_id")
        assert r == want[conv], conv
    return got


def letters(rng, n, weights=None):
    return "".join(rng.choices(C.LETTERS, weights, k=n)).encode()


def as_rows(codes):
    """Rows whose classes and faults are those of the letters."""
    out, seen = [], None
    for i, c in enumerate(codes):
        r, f = divmod(c - 65, 4)
        out.append((["system", "user", "assistant", "tool"][r], ["t%d." % i, "", "t%d." % i, "t%d" % i][f], ["", "blank", "duplicate", "truncated"][f]))
    return out


@pytest.mark.parametrize("block", [1, 3, 16, 1000])
def test_auction_is_the_least_cheapest_path(monkeypatch, block):
    import tests.llm.test_conversations as T
    rng = random.Random(block)
    for _ in range(300):
        codes = letters(rng, rng.randint(1, 25))
        rows = as_rows(codes)
        monkeypatch.setattr(T, "faults", lambda pairs, rows=rows: [r[2] for r in rows])
        cost, audit, _ = T.cheapest([r[:2] for r in rows])
        assert C.auction(codes, block) == (cost, audit)


def test_a_long_conversation_takes_linear_work():
    import time
    rng = random.Random(3)
    codes = letters(rng, 20_000)
    start = time.time()
    cost, audit = C.auction(codes)
    assert time.time() - start < 20 and len(audit.replace("I", "")) == 20_000
    assert C.auction(codes[:3000], 16)[0] == C.auction(codes[:3000], 64)[0]


def random_table(rng, convs, extra=()):
    out = list(extra)
    for c in range(convs):
        texts = [f"Text {rng.randrange(4)}{rng.choice(['.', '!', '?', '', ' ', chr(10)])}" for _ in range(4)] + ["", " \t", "é."]
        turns = list(range(rng.randint(1, 14)))
        for t in turns:
            if rng.random() < 0.9:
                out.append((c, t * rng.choice([1, 1, 1, 3]) if rng.random() < 0.9 else t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(texts)))
    return [r for i, r in enumerate(out) if (r[0], r[1]) not in {(x[0], x[1]) for x in out[:i]}]


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    check(spark, random_table(random.Random(seed), 120))


def test_nulls_ties_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    table = [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (7, None, "system", "s."), (7, 2, "user", None), (7, 3, None, "x."),
             (8, None, "user", "u."), (9, 1, "user", "q?"), (9, 1, "user", "q?"), (9, 5, "assistant", "r\n"), (-3, -2, "assistant", "z.")]
    df = spark.createDataFrame(table, SCHEMA)
    for c in ("k", "pos", "at", "letter", "codes", "c", "copy", "tie", "audit", "_chunk"):
        df = df.withColumn(c, F.lit("x"))
    check(spark, table, df)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(11)
    hot = [(5000, t, rng.choice(["user", "assistant"]), f"m{rng.randrange(300)}" + rng.choice([".", "!", ""])) for t in range(3000)]
    check(spark, random_table(rng, 20, hot))


def test_dropped_conversations_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(gone, 0, "user", "a."), (gone + 1, 0, "user", "a.")])
    assert rows_of(C.audit(spark, spark.createDataFrame([], SCHEMA))) == []


def test_repaired_rows_are_legal(spark):
    table = random_table(random.Random(4), 60)
    _, rows = C.repair(spark, C.damage(spark.createDataFrame(table, SCHEMA)))
    by = defaultdict(list)
    for r in rows_of(rows):
        by[r["k"]].append((r["at"], r["role"][:1]))
    for k, found in by.items():
        found.sort()
        assert [a for a, _ in found] == list(range(1, len(found) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(r for _, r in found)), k


def test_the_table(spark):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()],
          spark.read.parquet(f"{SF001}/conversations.parquet"))


def test_query_matches_sql(spark, con001):
    from streamops.llm.queries import ORACLE, QUERIES
    from tests.oracle import compare
    df = QUERIES["op13_conversation_repair"](spark, SF001)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    ok, msg = compare(df, con001, ORACLE["op13_conversation_repair"])
    assert ok, msg
