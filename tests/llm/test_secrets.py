"""Secret scanning: base spans, the battery, false discoveries."""

import hashlib
import random
import re
import string
from collections import defaultdict

from streamops.llm import secrets
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of

PLAIN = {
    "assign": re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                         r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    spans = []
    for k, p in PLAIN.items():
        for m in p.finditer(text or ""):
            if len(m[1] if k == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[k]:
                spans.append((m.start(), list(PLAIN).index(k), k, m.end()))
    spans.sort()
    listed = ",".join(f"{k}:{a}:{z}" for a, _, k, z in spans)
    return {**{f"n_{k}": sum(s[2] == k for s in spans) for k in PLAIN},
            "base_sha256": hashlib.sha256(listed.encode()).hexdigest()}, set(filter(None, listed.split(",")))


def check(spark, df):
    texts = defaultdict(list)
    for r in df.collect():
        texts[r["doc_id"]].append(r["text"])
    got = rows_of(secrets.find(spark, df))
    assert len(got) == sum(map(len, texts.values()))
    for r in got:
        want = [brute(t) for t in texts[r["doc_id"]]]
        assert {k: r[k] for k in want[0][0]} in [w[0] for w in want]
        assert any(w[1] <= set(filter(None, r["spans"].split(","))) for w in want)
    return got


PIECES = ["password", "PassWord", "passwd", "secret", "tokEn", "api_key", "APIKEY", "api__key", "=", ":", " ", "  ", "\"", "'", "\n",
          "abcdef012345", "abcdef01234", "AKIA", "AKIAABCDEFGHIJKLMN", "AKIAABCDEFGHIJ", "0123456789abcdef", "0123456789abcde", "G",
          "é", "😀", "-", ".", "/", "+", "ſecret", "toKen", "x1"]


def test_base_spans_on_random_mixtures(spark):
    rng = random.Random(5)
    check(spark, documents(spark, ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 16))) for _ in range(800)], extra=True))


def test_hostile_and_long_texts(spark):
    check(spark, documents(spark, hostile() + ["password" + " " * 60_000 + "=abcdefghijklm", "a1" * 60_000, "AKIA" * 20_000,
                                               "token" * 20_000, "é" * 30_000 + " secret: 'abcdefABCDEF123'"]))


def test_the_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = check(spark, df)
    extra = [s for r in got for s in r["spans"].split(",") if s.startswith("random")]
    assert len(extra) <= 2                              # the table's other texts are words


def test_random_tokens_are_found_and_words_are_left(spark):
    rng = random.Random(9)
    syllables = ["ing", "tion", "eau", "ment", "re", "the", "an", "er", "ou", "ge", "heit", "ver"]
    long_word = lambda: "".join(rng.choice(syllables) for _ in range(10))
    keys = {}
    texts = []
    for i in range(120):
        t = [long_word() for _ in range(8)] + [f"{long_word()}-{long_word()}", f"{long_word()}2024"]
        if i % 6 == 0:
            alphabet = [string.ascii_letters + string.digits, string.ascii_uppercase + "234567", string.ascii_letters + string.digits + "+/"][i // 6 % 3]
            keys[i] = "".join(rng.choice(alphabet) for _ in range(40))
            t.insert(4, keys[i])
        texts.append(" ".join(t))
    got = {r["doc_id"]: r["spans"] for r in rows_of(secrets.find(spark, documents(spark, texts)))}
    found = sum(f"random:{texts[i].index(k)}:{texts[i].index(k) + 40}" in got[i] for i, k in keys.items())
    wrong = sum("random" in s for i, s in got.items() if i not in keys)
    assert found >= 0.9 * len(keys) and wrong <= 1


def test_battery():
    rng = random.Random(1)
    name, score, *p = secrets.battery("".join(rng.choice("0123456789abcdef") for _ in range(400)))
    assert name == "hex" and abs(score) < 4 and min(p) > 1e-4
    assert min(secrets.battery("0123456789abcdef" * 20)[3:]) < 1e-6         # even counts, but in order
    assert secrets.battery("a" * 40)[2] < 1e-6 and secrets.battery("ab" * 40)[3] < 1e-6
    assert secrets.battery("internationalisation" * 2)[2] < 1e-3
    assert secrets.battery("/////////////////////")[0] == "base64" and secrets.battery("+_" * 12) is None


def test_battery_rejects_uniform_draws_at_its_level():
    rng = random.Random(2)
    low = [0, 0, 0]
    for _ in range(2000):
        p = secrets.battery("".join(rng.choice(string.ascii_lowercase + string.digits) for _ in range(60)))[2:]
        for k in range(3):
            low[k] += p[k] < 0.05
    assert all(0.02 * 2000 < x < 0.08 * 2000 for x in low)


def test_thresholds_bound_false_discoveries():
    counts = [(9, b, True, False, 50) for b in range(160, 200)]             # words score 6 to 10
    counts += [(9, b, False, True, 5) for b in range(90, 110)]              # random tokens score about 0
    counts += [(9, b, False, True, 40) for b in range(150, 200)]            # the rest looks like words
    limit = secrets.thresholds(counts)[9]
    assert 109 <= limit < 150
    assert secrets.thresholds([(9, 180, False, True, 10)]) == {} and secrets.thresholds([]) == {}


def test_empty_and_null(spark):
    df = documents(spark, ["password=abcdefghijklmnop", None])
    assert secrets.find(spark, df.limit(0)).count() == 0
    assert [r["n_assign"] for r in sorted(check(spark, df.union(df)), key=lambda r: r["doc_id"])] == [1, 1, 0, 0]
