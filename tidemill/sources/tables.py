"""Reading, validating, landing and loading tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import COMMERCE


# --- CSV and validation -------------------------------------------------------------------


def read_csv_table(
    spark: SparkSession,
    directory: str,
    table: str,
    files: dict[str, str] | None = None,
    registry: dict[str, T.StructType] = COMMERCE,
    multiline: bool = False,
) -> DataFrame:
    """A registered table as all-text columns. `files` maps table names to file names.

    multiline=True accepts line breaks inside quoted fields; such a file is read by one task,
    so land free-text tables in several files.
    """
    name = (files or {}).get(table, f"{table}.csv")
    text = T.StructType([T.StructField(c, T.StringType()) for c in registry[table].fieldNames()])
    return spark.read.csv(f"{directory}/{name}", schema=text, header=True, escape='"', multiLine=multiline)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text and 'nan' count as missing."""
    return df.select(
        *[
            F.when(~F.lower(F.trim(F.col(f.name))).isin("", "nan"), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _parsed(name: str, kind: T.DataType) -> Column:
    """Text to the declared type, NULL when it does not fit. A whole number may end in '.0'."""
    if isinstance(kind, (T.IntegerType, T.LongType)):
        number = F.col(name).try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number).try_cast(kind)
    return F.col(name).try_cast(kind)


# Accepted range of review scores.
SCORE_RANGE = {"review_score": (1, 5)}


def tag_rows(raw: DataFrame, schema: T.StructType, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Typed columns plus `_errors`: missing required fields, unparsable values, out-of-range ones.

    One narrow pass; materialize the result when both the valid and the error rows are written.
    """
    clean = blanks_to_null(raw)
    typed = {f.name: _parsed(f.name, f.dataType) for f in schema}
    problems = []
    for f in schema:
        if not f.nullable:
            problems.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: missing")))
        problems.append(F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
    for name, (low, high) in (ranges or {}).items():
        problems.append(F.when(~typed[name].between(low, high), F.lit(f"{name}: must be {low}-{high}")))
    return clean.select(
        *[c.alias(n) for n, c in typed.items()],
        F.filter(F.array(*problems), lambda p: p.isNotNull()).alias("_errors"),
        F.to_json(F.struct(*clean.columns)).alias("_row"),
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size("_errors") == 0).drop("_errors", "_row")


def error_rows(tagged: DataFrame) -> DataFrame:
    """The landed row as JSON with its first error and all errors."""
    bad = tagged.where(F.size("_errors") > 0)
    return bad.select(F.col("_row").alias("row"), F.get("_errors", F.lit(0)).alias("error"), F.col("_errors").alias("errors"))


def validate_rows(raw: DataFrame, schema: T.StructType, ranges=None) -> tuple[DataFrame, DataFrame]:
    tagged = tag_rows(raw, schema, ranges)
    return valid_rows(tagged), error_rows(tagged)


def ingest_report(tagged: dict[str, DataFrame]) -> DataFrame:
    """Raw, valid and error counts per table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("raw_count"),
            F.count_if(F.size("_errors") == 0).alias("valid_count"),
            F.count_if(F.size("_errors") > 0).alias("error_count"),
        )
        for name, df in tagged.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- lake partitions ----------------------------------------------------------------------


def lake_path(root: str, layer: str, domain: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{domain}/{table}"


def write_partition(df: DataFrame, path: str, ingest_date: str) -> None:
    """Replace one dated partition; the other dates stay as they are."""
    (
        df.withColumn("ingest_date", F.lit(ingest_date).cast("date"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date").parquet(path)
    )


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from one directory listing (no file is opened)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_latest_partition(spark: SparkSession, path: str, ingest_date: str | None = None) -> tuple[str, DataFrame | None]:
    """("ok", rows) of the newest or named date; ("missing", None) when there is none."""
    dates = partition_values(spark, path, "ingest_date")
    wanted = ingest_date or (dates[-1] if dates else None)
    if wanted is None or wanted not in dates:
        return "missing", None
    return "ok", spark.read.parquet(path).where(F.col("ingest_date") == F.lit(wanted).cast("date"))


def load_bronze(df: DataFrame, columns: list[str], source: Column | None = None) -> DataFrame:
    """Declared columns only (absent ones NULL), blanks to NULL, and the file each row came from."""
    origin = source if source is not None else F.col("_metadata.file_path")
    kept = df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns],
        origin.alias("source_file"),
    )
    return blanks_to_null(kept)


def rows_to_json(df: DataFrame, table: str) -> DataFrame:
    """Each row as JSON with an id: the first of id, ID, {table}_id that holds a value, else a
    unique row number (unique and increasing, not dense)."""
    exact = {f.lower(): f for f in df.columns}
    candidates = [exact[c] for c in ("id", f"{table}_id".lower()) if c in exact]
    return df.select(
        F.lit(table).alias("source_table"),
        F.coalesce(
            *[F.col(c).cast("string") for c in candidates], F.monotonically_increasing_id().cast("string")
        ).alias("source_row_id"),
        F.to_json(F.struct("*")).alias("record_data"),
    )


def json_to_rows(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    return df.select(F.from_json("record_data", schema).alias("r")).select("r.*")


# --- several tables -----------------------------------------------------------------------


def read_many_tables(readers: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Open every table; the ones that fail are reported, not raised."""
    frames, errors = {}, {}
    for name, reader in readers.items():
        try:
            frames[name] = reader()
        except Exception as exc:  # noqa: BLE001 - any reader failure is a skipped table
            errors[name] = str(exc).splitlines()[0]
    return frames, errors


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def source_row_counts(frames: dict[str, DataFrame], prefixes: dict[str, str]) -> DataFrame:
    """Rows per table, and the total per source, by table-name prefix."""
    source = reduce(
        lambda c, kv: c.when(F.col("table_name").startswith(kv[1]), F.lit(kv[0])), prefixes.items(), F.when(F.lit(False), F.lit(None))
    )
    counts = table_counts(frames).withColumn("source_id", source).where(F.col("source_id").isNotNull())
    total = counts.groupBy("source_id").agg(F.sum(F.when(F.col("row_count") > 0, F.col("row_count"))).alias("total_rows"))
    return counts.join(total, "source_id")


def profile_source(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns, types and row counts of every table and view of a database."""
    tables = [t.name for t in spark.catalog.listTables(database)]
    full = [f"{database}.{t}" if database else t for t in tables]
    rows = [
        (t, c.name, c.dataType, bool(c.nullable))
        for t, f in zip(tables, full)
        for c in spark.catalog.listColumns(f)
    ]
    columns = spark.createDataFrame(rows, "table_name string, column_name string, data_type string, is_nullable boolean")
    return columns.join(table_counts({t: spark.table(f) for t, f in zip(tables, full)}), "table_name")


def read_parquet_glob(spark: SparkSession, pattern: str, **constants) -> DataFrame:
    """All Parquet files of a pattern with constant columns added."""
    return spark.read.parquet(pattern).withColumns({k: F.lit(v) for k, v in constants.items()})

