"""Sources, sinks, quality, incremental loads, streams and the statement guard."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill import schemas, session
from tidemill.operators import incremental as inc
from tidemill.operators import quality as dq
from tidemill.plans.guard import StatementRefused, capped_query, check_statement
from tidemill.session import scratch_path, shared_dir
from tidemill.sources import jdbc, sinks
from tidemill.sources import tables as tb
from tidemill.streaming import bars, ingest

T0 = dt.datetime(2024, 1, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


# --- guard ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text",
    [
        "SELECT * FROM t", "SHOW TABLES", "DESCRIBE t;", " WITH c AS (SELECT 1) SELECT * FROM c ;", "EXPLAIN SELECT 1", "VALUES (1)",
        "SELECT 'drop; delete' AS `update` -- insert", "SELECT * FROM (SELECT * FROM t LIMIT 3) u", "SELECT updated_at, call FROM t",
    ],
)
def test_read_only_statements_pass(spark, text):
    check_statement(spark, text)


@pytest.mark.parametrize(
    "text",
    [
        "", " ;", "INSERT INTO t VALUES (1)", "DELETE FROM t", "SELECT 1; DROP TABLE u", "SELECT 1; SELECT 2", "WITH x AS (SELECT 1) MERGE INTO t",
        "UPDATE t SET a = 1", "DROP TABLE t", "CREATE TABLE t AS SELECT 1", "ALTER TABLE t ADD COLUMN b INT", "TRUNCATE TABLE t",
        "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "FROM t INSERT INTO u SELECT a INSERT INTO v SELECT b", "SET a = b",
        "CACHE TABLE t", "MERGE INTO t USING u ON t.a = u.a WHEN MATCHED THEN DELETE", "SELECT TRANSFORM(a) USING 'cat' FROM t", "CALL p()",
    ],
)
def test_other_statements_are_refused(spark, text):
    with pytest.raises(StatementRefused):
        check_statement(spark, text)


@pytest.mark.parametrize("text", ["SELECT * FROM twenty", "SELECT * FROM twenty;", "SELECT * FROM (SELECT * FROM twenty LIMIT 15)", "SELECT id, 'limit 3' AS l FROM twenty"])
def test_rows_are_capped(spark, text):
    spark.range(20).createOrReplaceTempView("twenty")
    cut = capped_query(spark, text, 7)
    assert cut.rows.count() == 7 and cut.truncated
    cut.release()
    whole = capped_query(spark, text, 20)
    assert not whole.truncated
    whole.release()


# --- sources and sinks ----------------------------------------------------------------------


def test_validation_splits_rows(spark):
    raw = spark.createDataFrame(
        [("r1", "o1", "5", " ", None, "2024-01-01", "nan"), ("r2", "", "3", None, None, None, None), ("r3", "o1", "9", None, None, "x", None), ("r4", "o1", "4.0", None, None, None, None)],
        ", ".join(f"{c} string" for c in schemas.COMMERCE["reviews"].fieldNames()),
    )
    good, bad = tb.validate_rows(raw, schemas.COMMERCE["reviews"], tb.SCORE_RANGE)
    assert [(r["review_id"], r["review_score"]) for r in good.orderBy("review_id").collect()] == [("r1", 5), ("r4", 4)]
    assert [r["errors"] for r in bad.orderBy("row").collect()] == [
        ["order_id: missing"], ["review_creation_date: not a timestamp", "review_score: must be 1-5"],
    ]


def test_partitions(spark):
    path = scratch_path(spark, "lake")
    assert tb.read_latest_partition(spark, path) == ("missing", None)
    for day, n in (("2024-01-02", 3), ("2024-01-10", 5), ("2024-01-02", 2)):
        tb.write_partition(spark.range(n), path, day)
    assert tb.partition_values(spark, path, "ingest_date") == ["2024-01-02", "2024-01-10"]
    assert tb.read_latest_partition(spark, path)[1].count() == 5
    assert tb.read_latest_partition(spark, path, "2024-01-02")[1].count() == 2
    assert tb.read_latest_partition(spark, path, "2023-01-01")[0] == "missing"
    assert sinks.drop_expired_partitions(spark, path, "ingest_date", lambda d: d >= "2024-01-05") == ["2024-01-02"]
    assert spark.read.parquet(path).count() == 5


def test_replaced_table_reads_the_complete_version(spark):
    path = scratch_path(spark, "table")
    assert sinks.current_version(spark, path) is None
    for n in (3, 4, 5):
        sinks.replace_table(spark.range(n), path)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=9")
    assert sinks.current_version(spark, path).count() == 5
    assert sinks.drop_versions(spark, path, keep=2) == [1, 2]


def test_failed_tables_are_reported(spark):
    frames, errors = tb.read_many_tables({"ok": lambda: spark.range(2), "no": lambda: spark.read.parquet("/no/such/path")})
    assert list(frames) == ["ok"] and list(errors) == ["no"]


def test_ids_of_json_rows(spark):
    df = spark.createDataFrame([(None, 7), ("x", 8)], "ID string, thing_id long")
    rows = tb.rows_to_json(df, "thing").collect()
    assert [r["source_row_id"] for r in rows] == ["7", "x"]
    assert len({r["source_row_id"] for r in tb.rows_to_json(spark.range(5).toDF("n"), "t").collect()}) == 5


def test_jdbc_subquery_and_ranges():
    assert jdbc.table_query("t", ["a", "b"], "a > 1") == "(SELECT a, b FROM t WHERE a > 1) AS part"
    assert jdbc.partition_options("id", 1, 9, 4)["numPartitions"] == "4"


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


# --- quality --------------------------------------------------------------------------------


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    row = dq.check_fk("child", child, "k", "parent", parent, "id").first()
    assert (row["observed"], row["passed"]) == (2.0, False)


def test_nulls_pass_value_rules_and_unknown_rules_pass(spark):
    df = spark.createDataFrame([(None, None), ("a", 3)], "s string, n int")
    suite = [
        {"type": "in_set", "column": "s", "value_set": ["a"]}, {"type": "between", "column": "n", "min_value": 1, "max_value": 5},
        {"type": "unique", "column": "s"}, {"type": "made_up"}, {"type": "not_null", "column": "s"}, {"type": "row_count_between", "min_value": 1, "max_value": 1},
    ]
    got = {r["check"]: r["passed"] for r in dq.expect_suite(df, suite).collect()}
    assert list(got.values()) == [True, True, True, True, False, False]


def test_empty_table_checks(spark):
    empty = spark.createDataFrame([], "s string")
    got = [r["passed"] for r in dq.expect_suite(empty, [{"type": "not_null", "column": "s"}, {"type": "row_count_between", "min_value": 1}, {"type": "column_exists", "column": "s"}]).collect()]
    assert got == [True, False, True]
    assert dq.check_row_count_match("t", empty, empty).first()["passed"] is True


def test_row_count_tolerance(spark):
    assert dq.check_row_count_match("t", spark.range(100), spark.range(96)).first()["passed"] is True
    assert dq.check_row_count_match("t", spark.range(100), spark.range(95)).first()["passed"] is False


# --- incremental ----------------------------------------------------------------------------


def test_empty_target_loads_everything(spark):
    source = spark.createDataFrame([(hours(0),), (hours(5),)], "ingested_at timestamp")
    none = source.where("false")
    assert inc.incremental_filter(source, none).count() == 2
    assert inc.incremental_lookback(source, none).count() == 2
    assert inc.incremental_filter(source, source.limit(1)).count() == 1
    assert inc.incremental_lookback(source, source, hours=5).count() == 1


def test_snapshot_changed_unchanged_new_deleted_returned(spark):
    def state(rows):
        return spark.createDataFrame(rows, "k string, v int, updated timestamp")

    def snap(history, rows, at):
        return inc.scd2_snapshot(history, state(rows), ["k"], "updated", F.lit(at))

    h = snap(None, [("same", 1, hours(0)), ("moves", 1, hours(0)), ("goes", 1, hours(0))], hours(1))
    h = snap(h, [("same", 1, hours(0)), ("moves", 2, hours(2)), ("new", 1, hours(2)), ("moves", 0, hours(1))], hours(3))
    h = snap(h, [("same", 1, hours(0)), ("moves", 2, hours(2)), ("new", 1, hours(2)), ("goes", 5, hours(4))], hours(5))
    got = sorted((r["k"], r["v"], r["valid_from"], r["valid_to"], r["is_current"]) for r in h.collect())
    assert [(k, v, a, z) for k, v, a, z, _ in got] == [
        ("goes", 1, hours(0), hours(3)), ("goes", 5, hours(4), None), ("moves", 1, hours(0), hours(2)),
        ("moves", 2, hours(2), None), ("new", 1, hours(2), None), ("same", 1, hours(0), None),
    ]
    assert all(current == (z is None) for _, _, _, z, current in got)


def test_failed_load_is_recorded_and_raised(spark):
    store = inc.CheckpointStore(spark, scratch_path(spark, "marks"))
    assert store.get("s", "t") is None
    data = spark.createDataFrame([(hours(3),)], "ingested_at timestamp")
    seen = []

    def fetch(start):
        seen.append(start)
        return data

    assert inc.incremental_load(store, "s", "t", fetch, lambda b: None, now=hours(10))["records_processed"] == 1
    assert store.get("s", "t") == hours(3)
    with pytest.raises(RuntimeError):
        inc.incremental_load(store, "s", "t", fetch, lambda b: (_ for _ in ()).throw(RuntimeError("disk")), now=hours(11))
    assert seen == [hours(10) - dt.timedelta(days=7), hours(2)]
    assert store.get("s", "t") == hours(3)  # the last mark that succeeded
    row = store.all().first()
    assert row["status"] == "failed" and row["error_message"] == "disk"
    later = hours(10) + dt.timedelta(days=30)
    inc.incremental_load(store, "s", "t", fetch, lambda b: None, now=later)
    assert seen[-1] == hours(2)  # a month after the failure nothing since the last success is skipped
    store.reset("s", "t", now=later + dt.timedelta(hours=1))
    assert store.get("s", "t") is None


def test_runs_once_per_date(spark):
    path = scratch_path(spark, "runs")
    inc.append_run(spark, path, source_schema="a", source_table="t", run_date=T0.date(), row_count=3, status="success")
    inc.append_run(spark, path, source_schema="a", source_table="u", run_date=T0.date(), row_count=0, status="failed")
    wanted = spark.createDataFrame([("a", "t", T0.date()), ("a", "u", T0.date())], "source_schema string, source_table string, run_date date")
    assert [r["source_table"] for r in inc.not_yet_done(wanted, spark.read.parquet(path)).collect()] == ["u"]


# --- streams --------------------------------------------------------------------------------


def trade_files(spark, batches):
    """One file per batch, read one per trigger in order of arrival."""
    path = scratch_path(spark, "trades")
    schema = "trade_id long, symbol string, price decimal(18,8), quantity decimal(18,8), trade_time timestamp"
    for rows in batches:
        df = spark.createDataFrame([(i, "S", float(p), 1.0, t) for i, p, t in rows], "trade_id long, symbol string, price double, quantity double, trade_time timestamp")
        df.selectExpr("trade_id", "symbol", "cast(price as decimal(18,8)) price", "cast(quantity as decimal(18,8)) quantity", "trade_time").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, stream):
    out = scratch_path(spark, "out")
    ingest.append_to(stream, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


def test_late_rows_are_dropped_and_out_of_order_rows_kept(spark):
    batches = [
        [(1, 10, hours(1.5)), (2, 11, hours(1.2))],
        [(3, 12, hours(8))],
        # Lateness is judged by the watermark of the batch before, so one more batch goes by.
        [(8, 12, hours(8.1))],
        [(4, 99, hours(1.4)), (5, 13, hours(7.9)), (6, 14, hours(20))],
        [(7, 1, hours(20.5))],
    ]
    rows = {r["price_hour"]: r for r in run(spark, bars.hourly_bars(trade_files(spark, batches))).collect()}
    assert set(rows) == {hours(1), hours(7), hours(8)}
    assert (rows[hours(1)]["open_price"], rows[hours(1)]["close_price"], rows[hours(1)]["trades_count"]) == (11.0, 10.0, 2)


def test_copies_within_the_delay_are_dropped(spark):
    batches = [[(1, 10, hours(1)), (1, 10, hours(1))], [(1, 10, hours(2)), (2, 5, hours(2))], [(2, 5, hours(3))]]
    assert sorted(r["trade_id"] for r in run(spark, bars.unique_trades(trade_files(spark, batches))).collect()) == [1, 2]


def test_topic_values_that_are_no_numbers_become_null(spark):
    df = spark.createDataFrame([('{"series_id":"A","observation_date":"2024-01-01","value":"."}',), ('{"series_id":"A","observation_date":"bad","value":"1.5"}',)], "value string")
    rows = ingest.parse_series(df).collect()
    assert rows[0]["value"] is None and rows[1]["observation_date"] is None and float(rows[1]["value"]) == 1.5


def test_replayed_batch_does_not_double_rows(spark):
    path = scratch_path(spark, "versions")
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, v int, n int")
    for batch in (0, 0, 1):
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    got = ingest.read_versioned(spark, path, ["k"], "v").collect()
    assert [(r["k"], r["v"]) for r in got] == [("a", 2)]
    target = scratch_path(spark, "compacted")
    ingest.compact(spark, path, target, ["k"], "v")
    assert spark.read.parquet(target).count() == 1


@pytest.mark.parametrize(("named", "used"), [(None, 16 << 20), ("64MB", 16 << 20), ("67108864", 16 << 20), ("8m", 8 << 20), ("16k", 16 << 10)])
def test_tasks_are_put_together_from_few_bytes(spark, named, used):
    key = session.TASK_BYTES_KEY
    kept = spark.conf.get(key, None)
    try:
        spark.conf.unset(key) if named is None else spark.conf.set(key, named)
        session.prepare(spark)
        assert session.size_in_bytes(spark.conf.get(key)) == used
    finally:
        spark.conf.unset(key) if kept is None else spark.conf.set(key, kept)
