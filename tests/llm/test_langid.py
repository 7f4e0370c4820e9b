"""Language identification: held-out accuracy, exact lookups, edge cases."""

import random
import zlib

import numpy as np

from streamops.llm import langid
from tests.conftest import SF01
from tests.llm.fixtures import documents, hostile, rows_of


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in df.select("doc_id", "lang", "text").collect()}
    got = rows_of(langid.identify(spark, df))
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got) and len(held) > 150
    right = sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held)
    assert right / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_lookups_equal_the_filters():
    rng = np.random.default_rng(3)
    net = langid.Network(["x", "y"], langid.byte_codes([b"hello world"])).ready()
    x = rng.integers(0, langid.CODES, (7, langid.WINDOW)).astype(np.uint8)
    best, _ = net.pooled(x)
    assert np.allclose(net.responses(x), np.tanh(np.concatenate(best, 1)), atol=1e-5)


def test_gradients_are_right():
    rng = np.random.default_rng(4)
    net = langid.Network(["x", "y", "z"], np.arange(256, dtype=np.uint8) % langid.CODES)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, label = rng.integers(0, langid.CODES, (5, 20)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        z = np.tanh(np.concatenate(net.pooled(x)[0], 1)) @ net.p["d"] + net.p["b"]
        return (np.log(np.exp(z).sum(1)) - z[np.arange(5), label]).mean()

    g = net.gradients(x, label)
    for k in net.p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        keep, e = net.p[k][at], 1e-6
        net.p[k][at] = keep + e
        up = loss()
        net.p[k][at] = keep - e
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / (2 * e) - g[k][at]) < 1e-5


def test_windows_cover_every_byte():
    codes = np.arange(256, dtype=np.uint8)
    texts = [b"", b"a", b"b" * langid.WINDOW, b"c" * (3 * langid.WINDOW + 5)]
    x, owner, share = langid.windows(texts, codes)
    assert owner.tolist() == [1, 2, 3, 3, 3, 3] and share.tolist() == [1, 128, 128, 128, 128, 5]
    assert (x[5] == ord("c")).sum() == 5


def test_edges(spark):
    rng = random.Random(9)
    de = ["".join(rng.choice(["sch", "ein", "ung ", "der ", "ü"]) for _ in range(60)) for _ in range(40)]
    fr = ["".join(rng.choice(["eau", "que ", "les ", "é", "tion"]) for _ in range(60)) for _ in range(40)]
    texts = de + fr + hostile() + ["123 456", "?!"]
    langs = ["de"] * 40 + ["fr"] * 40 + [None] * (len(texts) - 80)
    df = documents(spark, texts, extra=True, langs=langs)
    got = {r["doc_id"]: r for r in rows_of(langid.identify(spark, df))}
    assert all(got[i]["lang_pred"] == langs[i] for i in range(80))
    for i, t in enumerate(texts):
        none = t is None or not any(c.isalpha() for c in t)
        assert (got[i]["lang_pred"] == "und") == none and (got[i]["score"] == 0.0 or not none)
    assert langid.identify(spark, df.limit(0)).count() == 0
    alone = rows_of(langid.identify(spark, documents(spark, ["nothing known"], langs=[None])))
    assert alone[0]["lang_pred"] == "und" and alone[0]["score"] == 0.0
    twice = rows_of(langid.identify(spark, df.union(df)))
    assert len(twice) == 2 * len(texts)


def test_one_label_is_a_constant(spark):
    df = documents(spark, ["alpha beta gamma"] * 20, langs=["xx"] * 20)
    assert {r["lang_pred"] for r in rows_of(langid.identify(spark, df))} == {"xx"}


def test_labels_of_held_out_rows_are_not_learned(spark):
    ids = list(range(200))
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]
    df = documents(spark, ["some words here"] * 200, langs=["secret" if h else "open" for h in held], ids=ids)
    assert {r["lang_pred"] for r in rows_of(langid.identify(spark, df))} == {"open"}
