"""What the plans must look like to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from traceops.operators import keyed, neighbours, placement
from traceops.plans.jobs import JOBS
from traceops.plans.oracles import ORACLES
from traceops.plans.tables import QUERIES
from traceops.sources.trace import table_schema

SF = "/root/testdata/sf0.001"
STREAMS = ("a10_", "a11_", "a12_", "a13_", "st1_", "st3_", "st7_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """As on large data: no side is small enough to be broadcast on its own."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(STREAMS)])
def test_no_cross_joins_and_no_python(spark, no_small_tables, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in text
    assert "BroadcastExchange" not in text


def test_newest_rows_are_found_before_the_shuffle(spark):
    log = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(keyed.latest_per_key(log, "user_id", ["ts", "event_id"], ["value"]))
    assert text.index("Exchange") < text.index("partial_max") and "Window" not in text


@pytest.mark.parametrize("ids", ["STRING", "BIGINT"])
def test_placement_hashes_its_rows(spark, ids):
    text = plan(placement.placement_spread(spark.createDataFrame([], f"job {ids}, machine {ids}"), "job", "machine"))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_one_shuffle_per_side_of_the_correlation(spark, no_small_tables):
    text = plan(QUERIES["a7_join_correlation_stats"](spark, SF))
    assert len(re.findall("Exchange hashpartitioning", text)) == 2
    assert "partial_sum" in text and "SortMergeJoin" in text


@pytest.mark.parametrize("name, columns", [
    ("a4_event_rate", "l_returnflag:string,l_linestatus:string"),
    ("a6_placement", "l_orderkey:bigint,l_suppkey:bigint"),
    ("a9_hourly_profile", "ts:timestamp_ntz,value:double"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, SF))


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_linestatus)]" in plan(QUERIES["a4_event_rate"](spark, SF))


@pytest.mark.parametrize("table, key", [("machine_events", "machine_id"), ("task_events", "machine_id"), ("task_usage", "machine_id")])
def test_newest_rows_of_trace_tables_are_hashed(spark, table, key):
    """Time and tie-breaker in one number of fixed width: no sort before the aggregate."""
    schema = table_schema(table)
    order = [c for c in ("timestamp", "start_time", "event_type") if c in schema.names]
    values = [f.name for f in schema if f.dataType.typeName() == "double"]
    text = plan(keyed.latest_per_key(spark.createDataFrame([], schema), key, order, values))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_evictions_job_has_no_sort_aggregate(spark, no_small_tables):
    tables = {t: spark.createDataFrame([], table_schema(t)) for t in JOBS["a5"].tables}
    for result, _ in JOBS["a5"].run(tables, lambda df: df).values():
        assert "SortAggregate" not in plan(result)


def _slices(spark, log, slice_rows):
    """The rows of each slice of the large keys, after checking that slices follow each other."""
    keys, total = neighbours._large_keys(log, "m", slice_rows)
    sliced = neighbours._sliced(log.join(keys, log.m.eqNullSafe(keys["_key"]), "left_semi"), "m", slice_rows, total)
    ends = sliced.groupBy("m", "_slice").agg(F.count("*").alias("n"), F.min(F.struct(*log.columns)).alias("a"),
                                             F.max(F.struct(*log.columns)).alias("b")).orderBy("m", "_slice").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]) if x.m == y.m)
    return [r.n for r in ends], total


SLICED = {
    "a third in one key": "SELECT IF(id % 3 = 0, 0, id) AS m, id AS t, 0 AS tie",
    "a time at the end of the range": f"SELECT 0 AS m, IF(id = 7, {2**63 - 1}, id) AS t, 0 AS tie",
    "a burst in a long history": f"SELECT 0 AS m, IF(id % 10 < 9, {10**15} + id % 3, id * {10**12}) AS t, id AS tie",
    "one time": "SELECT 0 AS m, 5L AS t, id AS tie",
    "large keys side by side": "SELECT id % 20 AS m, id div 7 AS t, id % 3 AS tie",
    "no key": "SELECT CAST(NULL AS BIGINT) AS m, id % 1000 AS t, id AS tie",
}


@pytest.mark.parametrize("case", SLICED)
def test_slices_are_of_equal_row_counts(spark, case):
    """Whatever the times are like, no task of the window gets more than twice the rows it should."""
    log = spark.sql(f"{SLICED[case]} FROM range(60000)")
    sizes, total = _slices(spark, log, 1000)
    assert max(sizes) <= 2000 and sum(sizes) == total > 0
    assert len(sizes) <= 2 * total / 1000 + 40


def test_slices_of_one_row_that_fills_a_key(spark):
    log = spark.sql("SELECT 0 AS m, 5L AS t, 1 AS tie FROM range(50000) UNION ALL SELECT 0, id, 2 FROM range(5000)")
    sizes, total = _slices(spark, log, 1000)
    assert total == 55_000 and sum(sizes) == 5001 and max(sizes) <= 2000


def test_no_list_of_keys_is_cut_off(spark, no_small_tables):
    log = spark.range(9000).selectExpr("id % 3000 AS m", "id AS t", "id % 2 AS e")
    pairs = neighbours.followed_by(log, "m", ["t"], F.expr("e = 1"), F.expr("e = 0"), [], slice_rows=2)
    assert "Limit" not in plan(pairs) and "Broadcast" not in plan(pairs)
    assert pairs.count() == neighbours.followed_by(log, "m", ["t"], F.expr("e = 1"), F.expr("e = 0"), [], slice_rows=None).count()


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
