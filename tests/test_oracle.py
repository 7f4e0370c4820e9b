"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from streamops.catalog import ORACLE, QUERIES
from tests.conftest import SF001
from tests.oracle import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con001, name):
    ok, msg = compare(QUERIES[name](spark, SF001), con001, ORACLE[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["w_start", "w_end", "rank", "vc", "cnt"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"sink_file_roundtrip"}))
def test_column_types_match_oracle(spark, con001, name):
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in QUERIES[name](spark, SF001).schema}
    rel = con001.sql(ORACLE[name])
    assert s == dict(zip(rel.columns, [str(t) for t in rel.types]))
