"""The pipeline against its stages' brute-force versions, one after another."""

import importlib.util
import random
import re
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from streamops.llm import quality
from streamops.llm.common import settle
from tests.conftest import ROOT, SF001
from tests.llm import test_decontaminate, test_minhash, test_packing, test_pii, test_quality
from tests.llm.fixtures import documents, hostile, rows_of, words
from tests.llm.test_packing import tokenizer  # noqa: F401

ORDER = ["quality_rules", "near_dedup", "decontamination", "personal_data", "bestfit_packing"]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ORDER and corpus_pipeline.ORACLE_SQL is None


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def masked(text):
    """Base spans by the brute-force finder, overlapping ones merged."""
    spans = sorted(test_pii.brute(text)[1], key=lambda s: (s[1], -s[2], list(test_pii.PLAIN).index(s[0])))
    out, at, end = [], 0, 0
    for k, a, z in spans:
        if out and a < end:
            end = max(end, z)
            continue
        out += [text[max(at, end):a], f"[{k.upper()}]"]
        at = end = z
    return "".join(out) + text[end:] if spans else text


def check(spark, docs, bench, sf_dir, tokenizer):  # noqa: F811
    stages = [f for _, f in corpus_pipeline.STAGES]
    columns = docs.columns
    one = settle(spark, stages[0](spark, docs, sf_dir), "t1")
    verdict = {r["doc_id"]: r["kept"] for r in rows_of(quality.verdicts(spark, docs))}
    assert {i for i, _ in rows(one)} == {i for i, k in verdict.items() if k}
    assert all(test_quality.brute(t)["base_failed"] for i, t in rows(docs) if t is None)
    two = settle(spark, stages[1](spark, one, sf_dir), "t2")
    assert sorted(i for i, _ in rows(two)) == sorted(g[0] for g in test_minhash.brute(rows(one)))
    three = settle(spark, stages[2](spark, two, sf_dir), "t3")
    leaks = {d for d, _ in test_decontaminate.brute(
        [(i, t) for i, t in rows(two) if any(" ".join(x.split()[:5]) in t or x in t for _, x in bench)], bench)}
    assert {i for i, _ in rows(two)} - {i for i, _ in rows(three)} >= leaks
    four = settle(spark, stages[3](spark, three, sf_dir), "t4")
    have, want = dict(rows(four)), {i: masked(t) for i, t in rows(three)}
    different = [i for i in want if have[i] != want[i]]
    assert set(have) == set(want) and all("[" in have[i] for i in different) and len(different) <= 0.02 * len(want) + 1
    for df in (one, two, three, four):
        assert df.columns == columns
    test_packing.check(spark, four, tokenizer)
    return four


def test_stage_by_stage_on_the_table(spark, tokenizer):  # noqa: F811
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    four = check(spark, docs, [(r["item_id"], r["text"]) for r in bench.collect()], SF001, tokenizer)
    got = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows_of(corpus_pipeline.run(spark, SF001)))
    want = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows_of(test_packing.pack(spark, four)))
    assert got == want


def test_hostile_rows_pass_through(spark):
    docs = documents(spark, hostile(), extra=True)
    docs = docs.union(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(spark, stage(spark, docs, SF001), "hostile")
    assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r["doc_id"] for r in rows_of(docs)]
    assert len(ids) == len(set(ids))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() >= len(ids)


def test_quality_rules_and_personal_data_run_no_python(spark):
    rng = random.Random(21)
    texts = ["Accept these terms of ours now please and read on carefully\n" + " ".join(words(rng, 40)) + f" mail a{i}@b.com"
             for i in range(60)] + ["too short"] * 3
    docs = documents(spark, texts)
    for name, hit in (("quality_rules", "Accept"), ("personal_data", "@")):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF001)
        kept = [r["text"] for r in out.collect()]
        assert len(kept) >= 60 and not any(hit in t for t in kept)
        assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_empty_table(spark):
    docs = documents(spark, ["x"]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF001).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}


def test_the_rest_works_without_the_package(tmp_path):
    """A copy of the repository without the folders: the entry still imports."""
    import shutil
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/streamops", tmp_path / "streamops", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)
    assert importlib.util.find_spec("streamops.llm") is not None
