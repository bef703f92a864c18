import os

import pytest

from pyspark.sql.types import StructType

import __spark_entry__ as driver
from oracle import compare, connect
from traceops.plans.tables import SCHEMAS

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, driver.queries()[name], driver.oracle_sql()[name], SF)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("table", list(SCHEMAS))
def test_declared_schemas(spark, table):
    found = spark.read.parquet(f"{SF}/{table}.parquet").schema
    assert found.simpleString() == StructType.fromDDL(SCHEMAS[table]).simpleString()


def test_entry(spark):
    assert driver.entry(spark).columns == ["user_id", "start", "end", "offline_time", "lost_power"]
