"""Secret scanning with a randomness test battery.

Base patterns (assigned values, access keys, long hex runs) are searched in the
whole text.  Beyond them, every long token of code characters is a candidate:
its encoding is inferred as the smallest alphabet that holds it, and three
tests ask whether it looks like uniform draws from that alphabet: chi-squared
uniformity of its characters, the number of runs above and below the middle of
the alphabet, and the serial correlation of neighbours.

A token must pass all three, and must also be far from ordinary long words.
Words made of letters only are the null sample: over all documents, per length
class, their chi-squared scores give a mean and a deviation, a candidate's
score below them gives a p-value, and the Benjamini-Hochberg step-up in each
length class bounds the share of false discoveries there.  Scores are kept as
counts in bins of a fixed number, so what reaches the driver has a fixed bound.

One scan writes a table of spans and candidates (no text, no shuffle); the
thresholds are then applied to that table.

Defined results: a null text has no spans; repeated rows give repeated results;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import as_text, settle

# Fixed by the contract.
ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS = 12, 18
# What a text must match for the patterns above to be tried (linear-time engine).
ASSIGN_GATE = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12}"
HEX_GATE = "[0-9a-f]{16}"

MIN_TOKEN = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}={{0,2}}")
CANDIDATE_GATE = rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN}}}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest alphabet to the largest, each in its own order.
ALPHABETS = (("decimal", DIGITS), ("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"),
             ("lower", LOWER), ("base36", DIGITS + LOWER), ("BASE36", DIGITS + UPPER), ("base62", DIGITS + UPPER + LOWER),
             ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"))
TABLES = [(name, len(a), np.array([a.find(chr(i)) for i in range(128)])) for name, a in ALPHABETS]
PASS = 1e-3                      # each test of the battery, against uniform draws
FALSE_DISCOVERY = 0.01
BIN, BINS, LOWEST = 0.1, 800, -10.0
WORD = re.compile(r"[A-Za-z]?[a-z]+\Z")


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str) -> tuple[str, float, float, float, float] | None:
    """(encoding, chi-squared score, and the p-values of chi-squared, runs and
    serial correlation under uniform draws); None if no alphabet holds it."""
    raw = np.frombuffer(token.rstrip("=").encode(), np.uint8)
    n = len(raw)
    for name, size, table in TABLES:
        x = table[raw]
        if x.min() >= 0:
            break
    else:
        return None
    counts = np.bincount(x, minlength=size)
    chi = float((counts * counts).sum()) * size / n - n
    score = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    # Wilson-Hilferty: the cube root of chi-squared over its degrees is near normal
    d = size - 1
    p_chi = upper_tail(((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))) if chi > 0 else 1.0
    side = x >= size / 2
    a = int(side.sum())
    b = n - a
    runs = 1 + int((side[1:] != side[:-1]).sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    y = x - x.mean()
    total = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / total if total else 1.0
    p_serial = 2 * upper_tail(abs(r + 1 / n) * math.sqrt(n))
    return name, score, p_chi, p_runs, p_serial


def length_class(n: int) -> int:
    """20-23, 24-31, 32-47, 48-63, 64-95, ...: two classes an octave."""
    k = n.bit_length() - 1
    return 2 * k + (n >= 3 << (k - 1))


SPAN = "struct<kind:string,start:bigint,end:bigint>"
CANDIDATES = "array<struct<start:bigint,end:bigint,cls:int,bin:int,word:boolean,uniform:boolean,encoding:string>>"
TABLE = f"doc_id long, base array<{SPAN}>, tokens {CANDIDATES}"


def base_spans(text: str, kinds=(True, True, True)) -> list[tuple[str, int, int]]:
    out = []
    if kinds[0]:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_ASSIGN]
    if kinds[1]:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if kinds[2]:
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def token_rows(text: str) -> list[dict]:
    out = []
    for m in CANDIDATE.finditer(text):
        t = m[0]
        if (b := battery(t)) is None:
            continue
        bin_ = min(BINS - 1, max(0, int((b[1] - LOWEST) / BIN)))
        out.append({"start": m.start(), "end": m.end(), "cls": length_class(len(t)), "bin": bin_,
                    "word": WORD.match(t) is not None, "uniform": min(b[2:]) > PASS, "encoding": b[0]})
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Per document its base spans and its candidates."""

    def run(batches):
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        cand = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cls", pa.int32()), ("bin", pa.int32()),
                          ("word", pa.bool_()), ("uniform", pa.bool_()), ("encoding", pa.string())])
        for b in batches:
            texts = as_text(b.column(1))
            gates = [pc.match_substring_regex(texts, ASSIGN_GATE).to_pylist(),
                     pc.match_substring(texts, "AKIA").to_pylist(), pc.match_substring_regex(texts, HEX_GATE).to_pylist()]
            long = pc.match_substring_regex(texts, CANDIDATE_GATE).to_pylist()
            base, tokens = [], []
            for i in range(b.num_rows):
                kinds = [g[i] for g in gates]
                text = texts[i].as_py() if any(kinds) or long[i] else ""
                base.append([dict(zip(("kind", "start", "end"), s)) for s in base_spans(text, kinds)])
                tokens.append(token_rows(text) if long[i] else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(tokens, pa.list_(cand))],
                                             ["doc_id", "base", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, TABLE)


def thresholds(counts: list[tuple[int, int, bool, bool, int]], rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Per length class the highest bin that the step-up accepts.

    ``counts``: (class, bin, word, uniform, n).  Words give the null's mean and
    deviation; a class with fewer than 30 of them uses all classes' words.  All
    other tokens are tests; a bin's p-value is taken at its upper edge."""
    def moments(rows):
        n = sum(r[4] for r in rows)
        if n < 30:
            return None
        centre = [(LOWEST + (r[1] + 0.5) * BIN, r[4]) for r in rows]
        mean = sum(x * k for x, k in centre) / n
        return mean, max(1.0, math.sqrt(sum((x - mean) ** 2 * k for x, k in centre) / n))

    words = [r for r in counts if r[2]]
    pooled = moments(words) or (8.0, 2.0)              # nothing to learn from: a cautious guess
    out = {}
    for cls in sorted({r[0] for r in counts if not r[2]}):
        mean, dev = moments([r for r in words if r[0] == cls]) or pooled
        tests = [r for r in counts if r[0] == cls and not r[2]]
        m, seen, best = sum(r[4] for r in tests), 0, None
        for b in range(BINS):
            here = sum(r[4] for r in tests if r[1] == b)
            seen += here
            if here and upper_tail((mean - (LOWEST + (b + 1) * BIN)) / dev) <= rate * seen / m:
                best = b
        if best is not None:
            out[cls] = best
    return out


def find(spark: SparkSession, docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    table = settle(spark, scan(docs), "secrets")
    counts = table.select(F.explode("tokens").alias("t")).groupBy("t.cls", "t.bin", "t.word", "t.uniform").count()
    limit = thresholds([tuple(r) for r in counts.collect()], rate)   # at most classes x bins x 4 rows

    def run(batches):
        for b in batches:
            rows = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for base, tokens in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans = [(s["start"], s["end"], s["kind"]) for s in base]
                for k in BASE_KINDS:
                    rows[f"n_{k}"].append(sum(s[2] == k for s in spans))
                rows["base_sha256"].append(hashlib.sha256(listed(spans).encode()).hexdigest())
                for t in tokens:
                    if (not t["word"] and t["uniform"] and t["bin"] <= limit.get(t["cls"], -1)
                            and not any(s[0] < t["end"] and t["start"] < s[1] for s in spans[:len(base)])):
                        spans.append((t["start"], t["end"], "random"))
                order = (*BASE_KINDS, "random")
                rows["spans"].append(listed(sorted(spans, key=lambda s: (s[0], order.index(s[2])))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(rows[k], pa.int64()) for k in ("n_assign", "n_access", "n_hex")),
                 pa.array(rows["base_sha256"], pa.string()), pa.array(rows["spans"], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return table.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in spans)
