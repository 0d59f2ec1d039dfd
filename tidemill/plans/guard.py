"""Ad-hoc SQL for readers: one query, SHOW, DESCRIBE or EXPLAIN, and a cap on its rows.

What a text does is judged by the plan that Spark's parser makes of it, so words in strings, names and comments
mean nothing here. Its expressions are judged too, those of subqueries and named queries included: functions that call
code by its name are refused, and so are files read by their path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

LOGICAL = "org.apache.spark.sql.catalyst.plans.logical"
EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions"
# fixed values: functions that call any Java method, and names by which files are read in place
CALLS_CODE = ("java_method", "reflect", "try_reflect")
FILE_FORMATS = ("avro", "binaryfile", "csv", "json", "orc", "parquet", "text", "xml")
LOOKS_ONLY = ("Show", "Describe", "Explain")  # how the parser's nodes of such statements begin


class StatementRefused(ValueError):
    """The text is not one statement that only reads."""


def _each(items: JavaObject) -> Iterator[JavaObject]:
    for i in range(items.size()):
        yield items.apply(i)


def _nodes(plan: JavaObject) -> Iterator[JavaObject]:
    """All nodes of a plan and of the named queries in it."""
    yield plan
    for below in (plan.children(), plan.innerChildren()):
        for node in _each(below):
            yield from _nodes(node)
    if plan.nodeName() == "ExplainCommand":
        yield from _nodes(plan.logicalPlan())


def _expressions(gateway, top: JavaObject) -> Iterator[JavaObject]:
    """An expression and what is in it, plans of subqueries included."""
    yield top
    for part in _each(top.children()):
        yield from _expressions(gateway, part)
    if is_instance_of(gateway, top, f"{EXPRESSIONS}.PlanExpression"):
        for node in _nodes(top.plan()):
            yield from _judged(gateway, node)


def _judged(gateway, node: JavaObject) -> Iterator[JavaObject]:
    """A node's expressions; raises StatementRefused if the node itself acts or reads a file by its path."""
    kind = node.nodeName()
    acts = any(is_instance_of(gateway, node, f"{LOGICAL}.{c}") for c in ("Command", "ParsedStatement", "ScriptTransformation", "Call"))
    if acts and not kind.startswith(LOOKS_ONLY):
        raise StatementRefused(f"not a read-only statement: {kind}")
    if is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.analysis.UnresolvedRelation"):
        parts = list(_each(node.multipartIdentifier()))
        if len(parts) == 2 and ("/" in parts[1] or ":" in parts[1] or parts[0].lower() in FILE_FORMATS):
            raise StatementRefused(f"a file is read by its path: {'.'.join(parts)}")
    for top in _each(node.expressions()):
        yield from _expressions(gateway, top)


def check_statement(spark: SparkSession, text: str) -> None:
    """Raise StatementRefused unless `text` is one statement that changes nothing, starts no program and calls no code by name."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException as error:
        raise StatementRefused(str(error)) from error
    gateway = spark.sparkContext._gateway
    for node in _nodes(plan):
        for part in _judged(gateway, node):
            if is_instance_of(gateway, part, "org.apache.spark.sql.catalyst.analysis.UnresolvedFunction"):
                name = list(_each(part.nameParts()))[-1].lower()
                if name in CALLS_CODE:
                    raise StatementRefused(f"function {name} calls code by its name")


@dataclass
class CappedResult:
    """The first `max_rows` rows; `kept` holds them and one more, if there is one, and is to be released after use."""

    rows: DataFrame
    kept: DataFrame
    max_rows: int

    @property
    def truncated(self) -> bool:
        return self.kept.count() > self.max_rows

    def release(self) -> None:
        self.kept.unpersist()


def capped_query(spark: SparkSession, text: str, max_rows: int = 10_000) -> CappedResult:
    """Run one read-only statement and keep at most `max_rows` rows; their number and the rows come from one run."""
    check_statement(spark, text)
    kept = spark.sql(text).limit(max_rows + 1).persist()
    return CappedResult(kept.limit(max_rows), kept, max_rows)
