"""Driver contract: entry() smoke run and every query against its oracle."""

import pytest

import __spark_entry__ as entry
from pitwall.catalog import QUERIES
from pitwall.oracle import ORACLE
from tests.compare import duck, compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["PilotNumber", "NextLap", "prediction"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # the optional subpackage tests what SQL cannot express against brute force
    rows_only = set(QUERIES) - set(ORACLE)
    assert all(name.startswith("stream_") for name in rows_only), rows_only


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    df = entry.queries()[name](spark, SF)
    rel = duck(SF).sql(entry.oracle_sql()[name])
    spark_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    err = compare(df.toPandas(), rel.df())
    assert err is None, err
