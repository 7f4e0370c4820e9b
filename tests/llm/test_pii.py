"""Personal data: base spans against plain regular expressions, EM, masking."""

import hashlib
import random
import re
from collections import defaultdict

from streamops.llm import pii
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in hit.split(".")),
            "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]
    listed = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
    return {**{f"n_{k}": sum(s[0] == k for s in spans) for k in PLAIN},
            "base_sha256": hashlib.sha256(listed.encode()).hexdigest()}, spans


def check(spark, df):
    texts = defaultdict(list)
    for r in df.collect():
        texts[r["doc_id"]].append(r["text"])
    got = rows_of(pii.report(spark, df))
    assert len(got) == sum(map(len, texts.values()))
    for r in got:
        want = [brute(t) for t in texts[r["doc_id"]]]
        assert {k: r[k] for k in want[0][0]} in [w[0] for w in want], (r, want)
        have = set(filter(None, r["spans"].split(",")))
        assert any({f"{k}:{a}:{z}" for k, a, z in w[1]} <= have for w in want)
    return got


PIECES = ["a@b.c", "a@b.c_d@e.f", "x.y+z@mail-1.example.co.uk", "@b.c", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
          "01.002.0003.4", "999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999",
          "+49.30.123456", "+1", "+12", "+1 2", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "378282246310005", " ", ".", "-", "+", "é", "😀",
          "0", "12", "a", "@", "_", "%"]


def test_base_spans_on_random_mixtures(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    check(spark, documents(spark, texts, extra=True))


def test_base_spans_on_hostile_and_very_long_texts(spark):
    long = ["a." * 40_000 + "@b", "a@" + "b." * 40_000 + "c", "1" * 60_000, "1 " * 30_000, "1." * 30_000, "+1" + " " * 50_000,
            "q" * 80_000 + "@x.y " + "4111111111111111 " * 200]
    check(spark, documents(spark, hostile() + long))


def test_base_spans_on_the_table(spark):
    check(spark, spark.read.parquet(f"{SF001}/documents.parquet"))


def test_method_adds_spans_that_labelers_agree_on(spark):
    rng = random.Random(2)
    texts = []
    for i in range(60):
        texts += [f"please phone: {rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)} today",
                  f"my ssn {rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} is private",
                  f"write to mail jo{i} (at) example (dot) com soon", f"call +1 555 {rng.randint(100, 999)} 4567 now",
                  f"version {i}.{i + 1}.300.4 of the book, page 12-34-56"]
    got = {r["doc_id"]: r["spans"] for r in rows_of(pii.report(spark, documents(spark, texts)))}
    kinds = [{s.split(":")[0] for s in got[i].split(",") if s} for i in range(len(texts))]
    assert sum("ssn" in kinds[i] for i in range(1, 300, 5)) >= 55
    assert sum("mail" in kinds[i] for i in range(2, 300, 5)) >= 55
    assert not any(kinds[i] for i in range(4, 300, 5))


def test_em_learns_reliabilities():
    rng = random.Random(1)
    counts = defaultdict(int)
    for _ in range(4000):
        y = rng.random() < 0.3
        p = tuple((1 if (rng.random() < q) == y else -1) for q in (0.95, 0.9, 0.85, 0.8, 0.55))
        counts[p] += 1
    post = pii.em(sorted(counts.items()))
    assert post[(1, 1, 1, 1, 1)] > 0.95 and post[(-1, -1, -1, -1, -1)] < 0.05
    assert post[(1, 1, 1, -1, -1)] > post[(-1, -1, -1, 1, 1)]


def test_redact(spark):
    texts = ["é mail me: a.b@c.de or +1 (555) 010-9999!", "nothing here", None, "", "1.2.3.4", "a@b.cc1.2.3.4 x"]
    df = documents(spark, texts, extra=True)
    out = rows_of(pii.redact(spark, df.union(df)))
    assert pii.redact(spark, df).columns == df.columns and len(out) == 12
    by = {r["doc_id"]: r for r in out}
    assert by[0]["text"] == "é mail me: [EMAIL] or [PHONE]!" and by[1]["text"] == "nothing here"
    assert by[2]["text"] is None and by[3]["text"] == "" and by[4]["text"] == "[IP]"
    assert by[5]["text"] == "[EMAIL] x"               # overlapping spans become one
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out)


def test_empty_and_null(spark):
    df = documents(spark, ["a@b.c"])
    assert pii.report(spark, df.limit(0)).count() == 0 and pii.redact(spark, df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None, None, None, None), (None, "a@b.c", None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["n_email"] for r in rows_of(pii.report(spark, null))) == [0, 1]


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    for out in (pii.report(spark, df), pii.redact(spark, df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
