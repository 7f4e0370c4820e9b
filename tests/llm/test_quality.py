"""Quality rules against a brute-force reading of the contract."""

import random
import re
from collections import Counter, defaultdict

import pytest

from streamops.llm import quality
from tests.conftest import SF001
from tests.llm.fixtures import documents, hostile, rows_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(wins)
    inside = {p for i, x in enumerate(wins) if often[x] > 1 for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": dup, "n_repeat_words": len(inside), "base_failed": failed}


def check(spark, df):
    got = rows_of(quality.verdicts(spark, df).drop("_id", "_row", "removed"))
    texts = defaultdict(list)
    for r in df.collect():
        texts[r["doc_id"]].append(r["text"])
    assert len(got) == sum(map(len, texts.values()))
    for r in got:
        want = [brute(t) for t in texts[r["doc_id"]]]
        assert {k: r[k] for k in want[0]} in want
        assert not (r["base_failed"] and r["kept"])
    return got


def test_counts_on_hostile_texts(spark):
    rng = random.Random(3)
    texts = hostile(rng)
    for _ in range(30):                                # small vocabularies make many repeated windows
        texts.append(" ".join(rng.choice("ab") + rng.choice(["", "\n", "#"]) for _ in range(rng.randint(0, 60))))
    check(spark, documents(spark, texts, extra=True))


def test_counts_on_the_table(spark):
    check(spark, spark.read.parquet(f"{SF001}/documents.parquet"))


def test_query_equals_operator(spark):
    from streamops.llm.queries import QUERIES
    df = QUERIES["op10_quality_lines"](spark, SF001)
    assert df.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept"]
    assert df.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def boilerplate_docs(spark):
    rng = random.Random(5)
    line = "Please accept our terms 2024 and read on"
    own = [" ".join(words(rng, 40)) for _ in range(60)]
    texts = [f"{line}\n{t}" for t in own]                          # boilerplate beside an own text
    texts += [f"{line} \n" + " ".join(words(rng, 3)) for _ in range(10)]   # hardly anything else
    copies = " ".join(words(rng, 30)) + "\n" + " ".join(words(rng, 30))
    texts += [copies] * 80                                          # copies are not boilerplate
    return documents(spark, texts, sources=["h"] * len(texts)), line, own, copies


def test_lines_of_many_documents_go_and_copies_stay(spark):
    df, line, own, copies = boilerplate_docs(spark)
    got = {r["doc_id"]: r["kept"] for r in check(spark, df)}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in range(60, 70))
    assert all(got[i] for i in range(70, 150))
    out = {r["doc_id"]: r for r in rows_of(quality.filter_documents(spark, df))}
    assert sorted(out) == [i for i in range(150) if got[i]]
    assert [out[i]["text"] for i in range(60)] == own and out[70]["text"] == copies
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())


def test_depleted_documents_are_counted_by_their_text(spark):
    rng = random.Random(15)
    notice = " ".join(words(rng, 100))
    texts = [f"{notice}\n" + " ".join(f"own{i}w{k}" for k in range(5)) for i in range(100)]
    assert not any(r["kept"] for r in rows_of(quality.verdicts(spark, documents(spark, texts, sources=["h"] * 100))))
    # copies count neither for the line nor for its host
    own = [" ".join(words(rng, 40)) for _ in range(30)]
    texts = [f"{notice}\n{t}" for t in own] + [" ".join(words(rng, 40))] * 4000
    out = rows_of(quality.filter_documents(spark, documents(spark, texts, sources=["h"] * len(texts))))
    assert len(out) == len(texts) and sorted(r["text"] for r in out if r["doc_id"] < 30) == sorted(own)


def test_long_lines_have_one_limit_at_every_host_size(spark):
    rng = random.Random(16)
    notice, short = " ".join(words(rng, 55)), "See also below"
    own = [" ".join(words(rng, 20)) + f" end{i}" for i in range(3000)]
    texts = [f"{notice}\n{short}\n{t}" if i < 25 else t for i, t in enumerate(own)]
    out = {r["doc_id"]: r["text"] for r in rows_of(quality.filter_documents(
        spark, documents(spark, texts, sources=["h"] * len(texts))))}
    assert [out[i] for i in range(25)] == [f"{short}\n{t}" for t in own[:25]]
    assert [out[i] for i in range(25, 3000)] == own[25:]


def test_digits_and_spacing_do_not_hide_a_line(spark):
    rng = random.Random(6)
    texts = [f"Visit   number {i} OF this site today\n" + " ".join(words(rng, 30)) for i in range(10, 50)]
    out = rows_of(quality.filter_documents(spark, documents(spark, texts)))
    assert len(out) == 40 and not any("site" in r["text"] for r in out)


def test_hosts_have_limits_of_their_own(spark):
    rng = random.Random(8)
    texts = ["Shared line of words here\n" + " ".join(words(rng, 30)) for _ in range(40)]
    out = rows_of(quality.filter_documents(spark, documents(spark, texts, sources=[f"s{i % 20}" for i in range(39)] + [None])))
    assert all(r["text"].startswith("Shared") for r in out) and len(out) == 40


def test_extra_columns_repeated_rows_and_empty_tables(spark):
    df = documents(spark, hostile(), extra=True)
    out = quality.filter_documents(spark, df.union(df))
    assert out.columns == df.columns
    once = rows_of(quality.filter_documents(spark, df))
    assert sorted(map(str, rows_of(out))) == sorted(map(str, once * 2))
    assert quality.filter_documents(spark, df.limit(0)).count() == 0
    assert quality.verdicts(spark, df.limit(0)).count() == 0


def test_null_columns(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (None, "a b c d e f g h i j k", None, None, None)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["n_words"], r["kept"]) for r in rows_of(quality.verdicts(spark, df)))
    assert got == [(0, False), (11, True)]


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    for out in (quality.verdicts(spark, df), quality.filter_documents(spark, df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("n", [4, 5, 9, 10])
def test_short_texts(spark, n):
    r = rows_of(quality.verdicts(spark, documents(spark, [" ".join(words(random.Random(n), n))])))[0]
    assert r["n_words"] == n and r["kept"] == (n >= 10)
