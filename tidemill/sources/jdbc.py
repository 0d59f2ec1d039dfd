"""Tables of an external SQL database. Needs the database's JDBC driver on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

Options = dict[str, str]


def table_query(table: str, columns: list[str] | None = None, where: str | None = None, limit: int | None = None) -> str:
    """The part of a table to read, as a subquery the database runs itself."""
    text = f"SELECT {', '.join(columns) if columns else '*'} FROM {table}"
    if where:
        text += f" WHERE {where}"
    if limit is not None:
        text += f" ORDER BY 1 OFFSET 0 ROWS FETCH NEXT {int(limit)} ROWS ONLY"
    return f"({text}) AS part"


def read_jdbc_table(
    spark: SparkSession,
    connection: Options,
    table: str,
    columns: list[str] | None = None,
    where: str | None = None,
    limit: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A subset of a table over one connection. Further filters and columns are pushed down."""
    source = table_query(table, columns, where, limit) if columns or where or limit is not None else table
    return spark.read.format("jdbc").options(**connection, dbtable=source, fetchsize=fetch_size).load()


def partition_options(column: str, lower: str, upper: str, partitions: int) -> Options:
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc_partitioned(
    spark: SparkSession,
    connection: Options,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int = 64,
    columns: list[str] | None = None,
    where: str | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table read in parallel key ranges: each task runs one indexed range query."""
    source = table_query(table, columns, where) if columns or where else table
    ranges = partition_options(column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**connection, **ranges, dbtable=source, fetchsize=fetch_size).load()
