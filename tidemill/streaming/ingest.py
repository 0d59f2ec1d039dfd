"""Topic messages to typed tables with Structured Streaming.

The transforms take any DataFrame with a text column `value`, so the same code runs on a broker
topic, on files, and on a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill import schemas
from tidemill.functions.scalars import decimal_or_null
from tidemill.operators.ranking import latest_per_key
from tidemill.sources.keyed import KeyedTable, delete
from tidemill.sources.tables import partition_values

# Trigger interval and largest batch per topic.
FLUSH_SECONDS = {"trades": 1, "prices": 5, "sentiment": 10, "series": 10}
MAX_BATCH = {"trades": 65_536, "prices": 16_384, "sentiment": 1_024, "series": 8_192}


def read_topic(spark: SparkSession, servers: str, topic: str, max_batch: int | None = None) -> DataFrame:
    """A broker topic as text messages. Needs the Kafka source package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(spark: SparkSession, directory: str, files_per_trigger: int | None = None) -> DataFrame:
    """A directory of text files with one JSON message per line, picked up as files arrive."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(directory)


def _messages(df: DataFrame, topic: str) -> DataFrame:
    return df.select(F.from_json("value", schemas.TOPICS[topic]).alias("m")).where(F.col("m").isNotNull()).select("m.*")


def parse_trades(df: DataFrame) -> DataFrame:
    return _messages(df, "trades").select(
        "trade_id",
        "symbol",
        decimal_or_null(F.col("price"), 38, 10).alias("price"),
        decimal_or_null(F.col("quantity"), 38, 10).alias("quantity"),
        F.timestamp_millis("trade_time").alias("trade_time"),
        (F.col("is_buyer_maker") != 0).alias("is_buyer_maker"),
        "raw_data",
    )


def parse_prices(df: DataFrame) -> DataFrame:
    return _messages(df, "prices").select(
        "coin_id",
        "vs_currency",
        "timestamp_ms",
        decimal_or_null(F.col("price"), 38, 10).alias("price"),
        decimal_or_null(F.col("market_cap"), 38, 2).alias("market_cap"),
        decimal_or_null(F.col("total_volume"), 38, 2).alias("total_volume"),
    )


def parse_sentiment(df: DataFrame) -> DataFrame:
    return _messages(df, "sentiment").select(
        F.col("value_date").try_cast("date").alias("value_date"), "value", "classification", "timestamp_unix"
    )


def parse_series(df: DataFrame) -> DataFrame:
    return _messages(df, "series").select(
        "series_id",
        F.col("observation_date").try_cast("date").alias("observation_date"),
        decimal_or_null(F.col("value"), 38, 10).alias("value"),
    )


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "trades": parse_trades,
    "prices": parse_prices,
    "sentiment": parse_sentiment,
    "series": parse_series,
}


def append_to(
    stream: DataFrame, path: str, checkpoint: str, seconds: int | None = None, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table. Without an interval, read what is there and stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start(path)


def ingest_topic(messages: DataFrame, topic: str, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Parse a topic's messages and append them, stamped with their ingestion time."""
    typed = PARSERS[topic](messages).withColumn("ingested_at", F.current_timestamp())
    return append_to(typed, path, checkpoint, FLUSH_SECONDS[topic] if continuous else None)


def ingest_price_files(spark: SparkSession, directory: str, schema) -> DataFrame:
    """New Parquet price files as they arrive; the price date becomes epoch milliseconds."""
    prices = spark.readStream.schema(schema).parquet(directory)
    return prices.withColumn("timestamp_ms", F.unix_millis(F.col("price_date").cast("timestamp")))


# --- versioned table ----------------------------------------------------------------------


def base_table(spark: SparkSession, path: str, keys: list[str], version: str) -> KeyedTable:
    """The merged part of a replace-by-version table; its state says through which batch."""
    return KeyedTable(spark, f"{path}/_base", keys, (version,))


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Feed a replace-by-version table: every micro-batch lands in its own `batch` partition.

    A batch that is replayed after a failure overwrites its own partition, or is skipped if it has been merged already,
    so rows are never doubled. Older versions of a key are dropped on read and by `merge_batches`.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        through = KeyedTable(spark, f"{path}/_base", []).state().through
        if through is None or batch_id > through:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start()


def waiting_batches(spark: SparkSession, path: str, through: int | None) -> list[int]:
    """Complete batches that are not merged yet."""
    found = sorted(int(b) for b in partition_values(spark, path, "batch"))
    return [b for b in found if through is None or b > through]


def read_versioned(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    """Newest version of each key, from the merged base and the batches that came after it."""
    base = base_table(spark, path, keys, version)
    state = base.state()
    merged = base.read()
    waiting = waiting_batches(spark, path, state.through)
    if not waiting:
        return merged if merged is not None else spark.read.parquet(path).drop("batch")
    landed = spark.read.parquet(*[f"{path}/batch={b}" for b in waiting])
    rows = landed if merged is None else merged.unionByName(landed, allowMissingColumns=True)
    return latest_per_key(rows, keys, version)


def merge_batches(spark: SparkSession, path: str, keys: list[str], version: str) -> int | None:
    """Merge the waiting batches into the base, in one step, and drop them; the last batch that is merged.

    The base's new state and the mark of what it holds are one write. If the job is lost before it, the batches are
    still waiting; if it is lost after it, the merged batches are not read any more and go the next time.
    """
    base = base_table(spark, path, keys, version)
    state = base.state()
    waiting = waiting_batches(spark, path, state.through)
    if waiting:
        landed = spark.read.parquet(*[f"{path}/batch={b}" for b in waiting])
        state = base.merge(landed, through=waiting[-1])
    for b in partition_values(spark, path, "batch"):
        if state.through is not None and int(b) <= state.through:
            delete(spark, f"{path}/batch={b}")
    return state.through


def compact(spark: SparkSession, path: str, target: str, keys: list[str], version: str) -> None:
    """Export the newest versions as a plain table."""
    read_versioned(spark, path, keys, version).write.mode("overwrite").parquet(target)
