"""Statements that call code by name or read files by their path are refused wherever they hide."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import quality as dq
from tidemill.plans.guard import StatementRefused, check_statement

CALL = "reflect('java.lang.System', 'getProperty', 'user.home')"


@pytest.mark.parametrize(
    "text",
    [
        f"SELECT {CALL}", "SELECT JAVA_METHOD('a', 'b')", f"SELECT try_{CALL}", f"SELECT 1 + length(upper({CALL}))", f"SELECT * FROM t WHERE {CALL} = 'x'",
        f"WITH c AS (SELECT {CALL} AS x) SELECT * FROM c", f"SELECT (SELECT {CALL})", f"SELECT * FROM t WHERE a IN (SELECT {CALL} FROM u)",
        f"SELECT * FROM t WHERE EXISTS (SELECT 1 FROM u WHERE b = {CALL})", f"SELECT a FROM t ORDER BY {CALL}", f"SELECT count(*) FROM t GROUP BY {CALL}",
        f"SELECT * FROM t JOIN u ON t.a = {CALL}", f"SELECT sum(a) OVER (PARTITION BY {CALL}) FROM t", f"EXPLAIN SELECT {CALL}", f"SELECT builtin.{CALL}",
        f"SELECT transform(array(1), x -> {CALL})", "SELECT * FROM parquet.`/data/secret`", "SELECT * FROM csv.`s3://bucket/x`", "SELECT (SELECT max(a) FROM json.`f`)",
        "WITH c AS (SELECT * FROM text.`/etc/passwd`) SELECT * FROM c",
    ],
)
def test_calls_and_paths_are_refused(spark, text):
    with pytest.raises(StatementRefused):
        check_statement(spark, text)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT 'reflect(1)' AS reflect", "SELECT reflect FROM t", "SELECT * FROM db.t", "WITH parquet AS (SELECT 1 AS a) SELECT parquet.a FROM parquet",
        "SELECT upper(a) FROM t WHERE a IN (SELECT b FROM u) ORDER BY (SELECT 1)", "SELECT exists(array(1), x -> x > 0)",
    ],
)
def test_plain_queries_pass(spark, text):
    check_statement(spark, text)


def test_uniqueness_repeats_no_row(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, None, 5), (2, None, 5), (3, "b", None)], "i int, s string, n int")
    suite = [
        {"type": "unique", "column": "i"}, {"type": "not_null", "column": "s"}, {"type": "unique", "column": "s"}, {"type": "unique", "column": "n"},
        {"type": "unique_combination", "columns": ["i", "s", "n"]}, {"type": "unique", "column": "absent"},
    ]
    results = dq.expect_suite(df, suite)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    assert [(r["passed"], r["observed"]) for r in results.collect()] == [(False, 2.0), (False, 2.0), (False, 1.0), (False, 1.0), (False, 1.0), (False, 0.0)]
    only = dq.expect_suite(df.where("i = 3").withColumn("k", F.lit(1)), [{"type": "unique", "column": "k"}]).collect()
    assert [r["passed"] for r in only] == [True]
    assert [r["passed"] for r in dq.expect_suite(df.where("false"), suite[:5]).collect()] == [True] * 5
