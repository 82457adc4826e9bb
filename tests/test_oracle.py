"""Every registered query against its DuckDB twin at sf0.001."""

import pytest

import __spark_entry__ as E
from hexflow.plans import registry
from tests.oracle_check import canon, duck
from tests.plan_report import summary

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "TimestampType()": "TIMESTAMP", "DateType()": "DATE"}
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin_or_is_rows_only():
    missing = set(registry.QUERIES) - set(E.oracle_sql())
    assert missing <= {"table_detail", "table_sizes"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["road_name", "window_start", "window_end", "avg_congestion_index", "traffic_status",
                          "total_observations"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    assert summary(sdf)["forbidden"] == []     # no cross join, nested loop or Python evaluation
    rows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 1
        return
    rel = con.sql(sql)
    spark_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert canon(sdf.columns, rows) == canon(rel.columns, rel.fetchall())
