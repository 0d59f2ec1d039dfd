"""Writing tables: partitioned exports, replacement, archives and capped exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.scalars import month_key
from tidemill.sources.tables import lake_path, partition_values, write_partition


def export_partitioned(df: DataFrame, path: str, date: str) -> None:
    """Write a table partitioned by month key.

    The rebalance brings the rows of a month together, so that not every task writes a file for
    every month; adaptive execution splits a month that is larger than a target file.
    """
    keyed = df.withColumn("yyyymm", month_key(F.col(date))).hint("rebalance", "yyyymm")
    keyed.write.mode("overwrite").partitionBy("yyyymm").parquet(path)


def export_marts(marts: dict[str, DataFrame], root: str, ingest_date: str, domain: str = "marts") -> dict[str, str]:
    """Archive each mart as a dated partition; returns where each went."""
    paths = {}
    for name, df in marts.items():
        paths[name] = lake_path(root, "gold", domain, name)
        write_partition(df, paths[name], ingest_date)
    return paths


def replace_table(df: DataFrame, path: str) -> str:
    """Build the new content next to the old one and return the new version's path.

    A version is visible to readers only once it is complete, so a failed build leaves the old
    content in place; `df` may read the table it replaces.
    """
    spark = df.sparkSession
    versions = [int(v) for v in partition_values(spark, path, "version")]
    target = f"{path}/version={max(versions, default=0) + 1}"
    df.write.mode("overwrite").parquet(target)
    return target


def current_version(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest complete version of a replaced table; None when there is none."""
    jvm = spark._jvm
    for v in sorted((int(v) for v in partition_values(spark, path, "version")), reverse=True):
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            return spark.read.parquet(f"{path}/version={v}")
    return None


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest versions of a replaced table."""
    jvm = spark._jvm
    old = sorted(int(v) for v in partition_values(spark, path, "version"))[:-keep]
    for v in old:
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/version={v}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return old


def export_head(df: DataFrame, path: str, n: int = 1000, fmt: str = "csv", order: list[str] | None = None) -> None:
    """The first rows of a table as CSV or JSON, in a given order when one is named."""
    head = (df.orderBy(*order) if order else df).limit(n)
    if fmt == "csv":
        head.write.mode("overwrite").option("header", True).csv(path)
    else:
        head.write.mode("overwrite").json(path)


def retain(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows no older than `days` before the newest one. A filter on the partition column prunes."""
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_dt_interval(days=F.lit(days)))


def drop_expired_partitions(spark: SparkSession, path: str, column: str, keep: Callable[[str], bool]) -> list[str]:
    """Delete the partitions whose value is not kept; no file is read."""
    jvm = spark._jvm
    gone = [v for v in partition_values(spark, path, column) if not keep(v)]
    for v in gone:
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={v}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return gone
