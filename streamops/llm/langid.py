"""Language identification by a byte convolutional network.

A window of WINDOW bytes of lower-cased UTF-8 goes through filters of several
widths, each filter's largest response over the window is kept (max pooling),
and a softmax layer reads the pooled responses.  Rare bytes share one code, so
a filter over one-hot codes is a sum of table rows; at prediction two
neighbouring codes are looked up at once, which gives the same sums.

Training is numpy on a bounded sample of labelled documents: at most PER_LABEL
documents of each label (chosen by hash over the whole table, whole texts
eligible, a SLICE characters long part of each).  Prediction covers every
window of every text: the window probabilities are averaged by their bytes.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if there is nothing to learn from; one label is learned as a
constant; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import as_text

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
CODES = 64                       # code 0 is padding, the last code is any rare byte
PER_LABEL = 250
SLICE = 4000
STEPS = 360
BATCH = 256
CHUNK = 512                      # windows looked up at once


class Network:
    """Filters K[width] of shape (width, CODES, FILTERS), biases and a softmax."""

    def __init__(self, labels: list[str], codes: np.ndarray, seed: int = 17):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.labels, self.codes = labels, codes
        self.p = {f"k{w}": rng.normal(0, 0.3 / w, (w, CODES, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.p["d"] = rng.normal(0, 0.2, (n, len(labels))).astype(np.float32)
        self.p["b"] = np.zeros(len(labels), np.float32)
        self.tables: dict[str, np.ndarray] = {}

    # -- training
    def pooled(self, x: np.ndarray):
        """The largest response of every filter and where it was."""
        best, place = [], []
        for w in WIDTHS:
            k, n = self.p[f"k{w}"], x.shape[1] - w + 1
            y = k[0][x[:, :n]]
            for o in range(1, w):
                y = y + k[o][x[:, o:o + n]]
            at = y.argmax(1)
            place.append(at)
            best.append(np.take_along_axis(y, at[:, None, :], 1)[:, 0, :])
        return best, place

    def gradients(self, x: np.ndarray, label: np.ndarray):
        best, place = self.pooled(x)
        h = np.tanh(np.concatenate(best, 1))
        z = h @ self.p["d"] + self.p["b"]
        prob = np.exp(z - z.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        prob[np.arange(len(x)), label] -= 1
        prob /= len(x)
        g = {"d": h.T @ prob, "b": prob.sum(0)}
        back = (prob @ self.p["d"].T) * (1 - h * h)
        f = np.arange(FILTERS)
        for i, w in enumerate(WIDTHS):
            part, gk = back[:, i * FILTERS:(i + 1) * FILTERS], np.zeros_like(self.p[f"k{w}"])
            for o in range(w):
                np.add.at(gk[o], (np.take_along_axis(x, place[i] + o, 1), np.broadcast_to(f, place[i].shape)), part)
            g[f"k{w}"] = gk
        return g

    def fit(self, x: np.ndarray, label: np.ndarray, steps: int = STEPS, rate: float = 0.02, seed: int = 29) -> None:
        """Adam over random batches; labels are drawn evenly."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(label == k) for k in range(len(self.labels))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x_) for k, x_ in self.p.items()}
        for t in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
            for k, g in self.gradients(x[pick], label[pick]).items():
                g = g + 1e-4 * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                step = rate * (1 - 0.9 * t / steps)
                self.p[k] = (self.p[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                             ).astype(np.float32)

    # -- prediction
    def ready(self) -> "Network":
        """Tables over pairs of codes: row a * CODES + b is k[o][a] + k[o + 1][b]."""
        for w in WIDTHS:
            k = self.p[f"k{w}"]
            for o in range(0, w - 1, 2):
                self.tables[f"{w}:{o}"] = (k[o][:, None, :] + k[o + 1][None, :, :]).reshape(-1, FILTERS).copy()
        return self

    def responses(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.intp) * CODES + x[:, 1:]
        out = []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            y = self.tables[f"{w}:0"][pair[:, :n]]
            for o in range(2, w - 1, 2):
                y += self.tables[f"{w}:{o}"][pair[:, o:o + n]]
            if w % 2:
                y += self.p[f"k{w}"][w - 1][x[:, w - 1:]]
            out.append(y.max(1))
        return np.tanh(np.concatenate(out, 1))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = []
        for a in range(0, len(x), CHUNK):
            z = self.responses(x[a:a + CHUNK]) @ self.p["d"] + self.p["b"]
            e = np.exp(z - z.max(1, keepdims=True))
            parts.append(e / e.sum(1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Label number and score of each text, over all of its windows."""
        x, owner, share = windows(texts, self.codes)
        prob = self.probabilities(x) * share[:, None]
        total = np.zeros((len(texts), len(self.labels)))
        np.add.at(total, owner, prob)
        total /= np.maximum(1e-9, total.sum(1, keepdims=True))
        best = total.argmax(1)
        return best, total[np.arange(len(texts)), best]


def windows(texts: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: codes, the text of each, and its bytes."""
    size = np.array([len(t) for t in texts], np.int64)
    n = -(-size // WINDOW)
    out = np.zeros((int(n.sum()), WINDOW), np.uint8)
    flat, at = out.reshape(-1), 0
    for t, k in zip(texts, n):
        flat[at:at + len(t)] = codes[np.frombuffer(t, np.uint8)]
        at += int(k) * WINDOW
    owner = np.repeat(np.arange(len(texts)), n)
    share = np.full(len(out), float(WINDOW), np.float32)
    last = np.cumsum(n)[n > 0] - 1
    share[last] = (size - (n - 1) * WINDOW)[n > 0]
    return out, owner, share


def byte_codes(texts: list[bytes]) -> np.ndarray:
    """Codes for the most frequent bytes of the sample; one for all others."""
    counts = np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256)
    codes = np.full(256, CODES - 1, np.uint8)
    order = np.argsort(-counts, kind="stable")[:CODES - 2]
    codes[order] = np.arange(1, len(order) + 1)
    return codes


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, per_label: int = PER_LABEL, slice_chars: int = SLICE) -> list[tuple[str, str]]:
    """About ``per_label`` labelled texts of each label, none held out."""
    text = F.col("text")
    known = docs.where(text.isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                       & text.rlike(r"\p{L}")).select(F.col("lang").cast("string").alias("lang"), text,
                                                       F.xxhash64("doc_id", "text").alias("h"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_label / n))))[F.col("lang")]
    chosen = known.where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)
    begin = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("text") - slice_chars + 1)) + 1
    rows = chosen.select("lang", "h", F.substring("text", begin.cast("int"), F.lit(slice_chars)).alias("t")).limit(
        2 * per_label * len(counts)).collect()
    return [(r["lang"], r["t"]) for r in sorted(rows, key=lambda r: (r["h"], r["lang"], r["t"]))]


def train(rows: list[tuple[str, str]], steps: int = STEPS) -> Network | None:
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    texts = [t.lower().encode() for _, t in rows]
    net = Network(labels, byte_codes(texts))
    x, owner, _ = windows(texts, net.codes)
    if len(labels) > 1:
        net.fit(x, np.array([labels.index(lang) for lang, _ in rows])[owner], steps)
    return net.ready()


def identify(spark: SparkSession, docs: DataFrame, per_label: int = PER_LABEL, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    net = train(sample(docs, per_label), steps)
    shared = spark.sparkContext.broadcast(net)          # its size depends on the labels only

    def run(batches):
        model = shared.value
        for b in batches:
            texts = as_text(b.column(2))
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            raw = [t.encode() for t in pc.utf8_lower(texts).to_pylist()]
            label, score = ["und"] * len(raw), np.zeros(len(raw))
            if model is not None:
                at = 0
                while at < len(raw):                    # parts of about 1 MB
                    end, size = at, 0
                    while end < len(raw) and size < 1 << 20:
                        size += len(raw[end])
                        end += 1
                    best, s = model.predict(raw[at:end])
                    for i in range(at, end):
                        if letters[i]:
                            label[i], score[i] = model.labels[best[i - at]], s[i - at]
                    at = end
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(label, pa.string()), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
