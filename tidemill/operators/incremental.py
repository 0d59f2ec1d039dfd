"""Incremental loads, merges, snapshots, checkpoints and run logs over plain Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.ranking import latest_per_key
from tidemill.schemas import CHECKPOINT, RUN_LOG
from tidemill.session import materialize
from tidemill.sources.keyed import KeyedTable, State

EPOCH = "1970-01-01 00:00:00"

# Python times without a zone are UTC here, whatever the zone of the machine.


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def as_utc(moment: datetime | None) -> datetime | None:
    return moment.replace(tzinfo=timezone.utc) if moment is not None and moment.tzinfo is None else moment


def at(moment: datetime) -> Column:
    """A timestamp literal for a Python time."""
    return F.lit(as_utc(moment).astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def incremental_filter(source: DataFrame, target: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Source rows newer than the newest target row; all rows when the target is empty."""
    mark = target.agg(F.max(column)).scalar()
    return source.where(F.coalesce(F.col(column) > mark, mark.isNull()))


def incremental_lookback(source: DataFrame, target: DataFrame, column: str = "ingested_at", hours: int = 1) -> DataFrame:
    """Like `incremental_filter` with an overlap of some hours; an empty target means 1970."""
    mark = target.agg(F.max(column) - F.make_dt_interval(hours=F.lit(hours))).scalar()
    return source.where(F.col(column) > F.coalesce(mark, F.lit(EPOCH).cast("timestamp")))


def merge_by_key(target: DataFrame, updates: DataFrame, keys: list[str], *version: str) -> DataFrame:
    """Target with updates applied: an update replaces the row of its key, others are added.

    Columns new in the updates are appended, NULL for old rows. Of repeated keys in the updates the newest by the
    version columns is used, without those the greatest row. `sources.keyed` does the same to a stored table and
    writes only the buckets that change.
    """
    new = latest_per_key(updates, keys, *version)
    untouched = target.join(new.select(*keys), keys, "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True)


def scd2_snapshot(
    history: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    updated_at: str,
    as_of: Column,
    close_deleted: bool = True,
) -> DataFrame:
    """Next state of a slowly changing history: valid_from, valid_to, is_current.

    A source row newer than the open row of its key closes that row and opens a new one; keys
    gone from the source are closed at `as_of`; a key that returns opens a new row.
    """
    columns = source.columns
    newest = latest_per_key(source, keys, updated_at)

    def opened(prefix: str) -> Column:
        return F.struct(
            *[F.col(f"{prefix}.{c}").alias(c) for c in columns],
            F.col(f"{prefix}.{updated_at}").alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
        )

    incoming = newest.select(*keys, F.struct(*columns).alias("new"))
    if history is None:
        rows = incoming.select(F.array(opened("new")).alias("rows"))
        return rows.select(F.inline("rows")).withColumn("is_current", F.lit(True))
    open_rows = history.where(F.col("valid_to").isNull()).select(*keys, F.struct(*columns, "valid_from").alias("old"))
    both = open_rows.join(incoming, keys, "full")

    def kept(end: Column) -> Column:
        return F.struct(
            *[F.col(f"old.{c}").alias(c) for c in columns], F.col("old.valid_from"), end.cast("timestamp").alias("valid_to")
        )

    never = F.lit(None).cast("timestamp")
    changed = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
    rows = (
        F.when(F.col("old").isNull(), F.array(opened("new")))
        .when(F.col("new").isNull(), F.array(kept(as_of if close_deleted else never)))
        .when(changed, F.array(kept(F.col(f"new.{updated_at}")), opened("new")))
        .otherwise(F.array(kept(never)))
    )
    closed = history.where(F.col("valid_to").isNotNull()).select(*columns, "valid_from", "valid_to")
    state = closed.unionByName(both.select(rows.alias("rows")).select(F.inline("rows")))
    return state.withColumn("is_current", F.col("valid_to").isNull())


def scd2_apply(
    table: KeyedTable, source: DataFrame, updated_at: str, as_of: Column, close_deleted: bool = True
) -> State:
    """Bring a stored history (a `KeyedTable` with several rows per key) to its next state.

    Only buckets with a changed, new or closed key are rewritten. Closing keys that are gone needs the open rows of all
    buckets; without it, the buckets of the source's keys are all that is read.
    """
    keys, history = table.keys, table.read()
    source = materialize(source, "snapshot")
    if history is None:
        rows = scd2_snapshot(None, source, keys, updated_at, as_of)
        return table.rewrite(rows, [r[0] for r in source.select(table.bucket).distinct().collect()])
    newest = latest_per_key(source.select(*keys, updated_at), keys, updated_at)
    if not close_deleted:
        history = table.read([r[0] for r in newest.select(table.bucket).distinct().collect()])
    open_rows = history.where(F.col("valid_to").isNull()).select(*keys, F.col(updated_at).alias("_open"))
    both = open_rows.join(newest, keys, "full")
    changed = F.col("_open").isNull() | (F.col(updated_at) > F.col("_open"))
    if close_deleted:
        changed = changed | F.col(updated_at).isNull()
    touched = [r[0] for r in both.where(changed).select(table.bucket).distinct().collect()]
    if not touched:
        return table.state()
    part = source.where(table.bucket.isin(touched))
    return table.rewrite(scd2_snapshot(table.read(touched), part, keys, updated_at, as_of, close_deleted), touched)


# --- checkpoints --------------------------------------------------------------------------


class CheckpointStore:
    """High-water marks per (source, table, column), kept as an append-only Parquet log.

    Appends never rewrite a file, so a lost job leaves earlier marks whole.
    """

    KEYS = ["source_name", "table_name", "checkpoint_column"]

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> DataFrame:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jvm_path):
            return self.spark.createDataFrame([], CHECKPOINT)
        return self.spark.read.schema(CHECKPOINT).parquet(self.path)

    def all(self) -> DataFrame:
        """Newest state of every mark, failed ones included."""
        return latest_per_key(self._log(), self.KEYS, "updated_at").orderBy(F.desc("updated_at"), *self.KEYS)

    def get(self, source: str, table: str, column: str = "ingested_at") -> datetime | None:
        """Value of the newest mark of a load that succeeded, if it has not been reset since."""
        wanted = (F.col("source_name") == source) & (F.col("table_name") == table) & (F.col("checkpoint_column") == column)
        counted = self._log().where(wanted & F.col("status").isin("success", "reset"))
        newest = latest_per_key(counted, self.KEYS, "updated_at").where("status = 'success'")
        row = newest.select(F.col("checkpoint_value").cast("timestamp_ntz").alias("v")).first()
        return row["v"] if row else None

    def save(
        self, source: str, table: str, column: str, value: datetime | None, records: int,
        status: str = "success", error: str | None = None, now: datetime | None = None,
    ) -> None:
        row = (source, table, column, as_utc(value), records, status, error, as_utc(now or utc_now()))
        self.spark.createDataFrame([row], CHECKPOINT).coalesce(1).write.mode("append").parquet(self.path)

    def reset(self, source: str, table: str, column: str = "ingested_at", now: datetime | None = None) -> None:
        self.save(source, table, column, None, 0, status="reset", now=now)


def incremental_load(
    store: CheckpointStore,
    source: str,
    table: str,
    fetch: Callable[[datetime], DataFrame],
    write: Callable[[DataFrame], None],
    column: str = "ingested_at",
    lookback_hours: int = 1,
    first_days: int = 7,
    now: datetime | None = None,
) -> dict:
    """Fetch from the mark less an overlap (first run: some days back), write, advance the mark.

    The source is read once, so rows that arrive meanwhile are left to the next run. A failure is recorded and raised;
    the next run then starts from the last mark that succeeded.
    """
    now = now or utc_now()
    mark = store.get(source, table, column)
    start = mark - timedelta(hours=lookback_hours) if mark else now - timedelta(days=first_days)
    try:
        batch = materialize(fetch(start), "load")  # the source is read once: what is counted is what is written
        counted = batch.agg(F.count("*").alias("n"), F.max(column).cast("timestamp_ntz").alias("top")).first()
        if counted["n"] == 0:
            return {"status": "success", "records_processed": 0, "start_time": start}
        write(batch)
        store.save(source, table, column, counted["top"], counted["n"], now=now)
    except Exception as exc:
        store.save(source, table, column, now, 0, status="failed", error=str(exc)[:500], now=now)
        raise
    return {
        "status": "success", "records_processed": counted["n"], "checkpoint_value": counted["top"], "start_time": start
    }


# --- run log ------------------------------------------------------------------------------


def append_run(spark: SparkSession, path: str, **fields) -> None:
    """Add one ingestion run to the log."""
    row = tuple(as_utc(v) if isinstance(v, datetime) else v for v in (fields.get(f.name) for f in RUN_LOG))
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def not_yet_done(wanted: DataFrame, log: DataFrame) -> DataFrame:
    """(source_schema, source_table, run_date) rows without a successful run."""
    keys = ["source_schema", "source_table", "run_date"]
    return wanted.join(log.where(F.col("status") == "success").select(*keys), keys, "left_anti")


def latest_runs(log: DataFrame) -> DataFrame:
    """Newest run by date of each source table."""
    return latest_per_key(log, ["source_schema", "source_table"], "run_date")


def checkpoint_totals(log: DataFrame) -> DataFrame:
    return log.groupBy("source_schema", "source_table").agg(F.sum("row_count").alias("total_rows"))


def source_health(log: DataFrame, sources: list[str]) -> DataFrame:
    """healthy when a source has any run, else unknown, with its row total."""
    seen = log.groupBy("source_schema").agg(F.count("*").alias("runs"), F.sum("row_count").alias("total_rows"))
    known = log.sparkSession.createDataFrame([(s,) for s in sources], "source_schema string")
    return known.join(seen, "source_schema", "left").select(
        "source_schema",
        F.when(F.col("runs") > 0, "healthy").otherwise("unknown").alias("status"),
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
    )
