"""Registered queries: a DataFrame plan, its output columns, and an equivalent SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.oracle_tables import TABLES
from tidemill.session import prepare

REGISTRY: dict[str, "Query"] = {}

_SPARK_TYPES = {"i": "bigint", "f": "double", "e": "double", "d": "date", "t": "timestamp_ntz", "b": "boolean", "s": "string"}
_SQL_TYPES = {"i": "BIGINT", "f": "DOUBLE", "e": "DOUBLE", "d": "DATE", "t": "TIMESTAMP", "b": "BOOLEAN", "s": "VARCHAR"}


@dataclass(frozen=True)
class Query:
    name: str
    columns: list[tuple[str, str, int]]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf: str) -> DataFrame:
        df = self.build(prepare(spark), sf)
        out = []
        for name, kind, digits in self.columns:
            c = F.col(name).cast(_SPARK_TYPES[kind])
            out.append((F.round(c, digits) if kind == "f" else c).alias(name))
        return df.select(*out)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        out = []
        for name, kind, digits in self.columns:
            text = f"CAST({name} AS {_SQL_TYPES[kind]})"
            out.append(f"round({text}, {digits}) + 0.0 AS {name}" if kind == "f" else f"{text} AS {name}")
        return with_tables(f"SELECT {', '.join(out)} FROM ({self.sql.strip()}) AS answer")


def parse_columns(spec: str) -> list[tuple[str, str, int]]:
    """'d: day | i: n m | f2: price' -> (name, type, digits) triples; f digits default to 9, e is an
    exact double."""
    out = []
    for part in spec.split("|"):
        kind, names = part.split(":")
        kind = kind.strip()
        digits = int(kind[1:]) if len(kind) > 1 else 9
        out += [(name, kind[0], digits) for name in names.split()]
    return out


def register(name: str, spec: str, sql: str | None = None):
    """Decorator: add a plan (spark, sf) -> DataFrame under a name."""

    def add(build):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, parse_columns(spec), build, sql)
        return build

    return add


def with_tables(sql: str) -> str:
    """Prefix the shared derived tables the text mentions, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(re.findall(r"\bx_\w+", text))
        for name in TABLES:
            if name in words and name not in needed:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in needed) + "\n" + sql
