"""Data-quality checks. Each check is one row: check, passed, observed, details.

Column rules of a table share one aggregate over one scan; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.scalars import hours_between, ratio


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def _wide_to_checks(one_row: DataFrame, rules: dict[str, tuple[Column, Column, str]]) -> DataFrame:
    """One aggregate row to check rows. A rule is (aggregate, passed given `observed`, unit)."""
    names = list(rules)
    counted = one_row.agg(*[rules[n][0].cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("observed"), F.lit(rules[n][2]).alias("details"))
            for i, n in enumerate(names)
        ]
    )
    rows = counted.select(F.inline(cells))
    verdict = reduce(
        lambda c, n: c.when(F.col("check") == n, rules[n][1]), names, F.when(F.lit(False), F.lit(None).cast("boolean"))
    )
    return rows.select("check", verdict.alias("passed"), "observed", "details")


def _none() -> Column:
    return F.col("observed") == 0


def bad_count(condition: Column) -> Column:
    """Number of rows that break a rule; NULL breaks none."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def check_row_count_match(name: str, source: DataFrame, target: DataFrame, tolerance_pct: float = fv.ROW_COUNT_TOLERANCE_PCT) -> DataFrame:
    """Target rows differ from source rows by less than the tolerance."""
    counted = source.agg(F.count("*").alias("source_rows")).withColumn("target_rows", target.agg(F.count("*")).scalar())
    diff = F.abs(F.col("source_rows") - F.col("target_rows"))
    pct = F.coalesce(ratio(diff * 100, F.col("source_rows")), F.lit(0.0))
    return counted.select(
        F.lit(f"row_count:{name}").alias("check"),
        ((F.col("source_rows") == F.col("target_rows")) | (pct < tolerance_pct)).alias("passed"),
        pct.alias("observed"),
        F.lit("difference in percent").alias("details"),
    )


def _null_rules(name: str, columns: list[str]) -> dict:
    return {f"not_null:{name}.{c}": (F.count_if(F.col(c).isNull()), _none(), "NULLs") for c in columns}


def check_not_null(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    return _wide_to_checks(df, _null_rules(name, columns))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows without a parent; a NULL key has none."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.join(keys, column, "left_anti")


def check_fk(child_name: str, child: DataFrame, column: str, parent_name: str, parent: DataFrame, parent_column: str) -> DataFrame:
    name = f"fk:{child_name}.{column}->{parent_name}.{parent_column}"
    # Counting keys first keeps a hot key from moving once per row.
    keys = child.groupBy(column).agg(F.count("*").alias("n"))
    orphans = fk_orphans(keys, column, parent, parent_column)
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("observed")).select(
        F.lit(name).alias("check"), _none().alias("passed"), "observed", F.lit("orphans").alias("details")
    )


def _range_rules(name: str, bounds: dict[str, tuple[float | None, float | None]]) -> dict:
    def outside(c: str, low, high) -> Column:
        too_low = F.col(c) < low if low is not None else F.lit(False)
        return too_low | (F.col(c) > high if high is not None else F.lit(False))

    return {f"range:{name}.{c}": (bad_count(outside(c, *b)), _none(), "values outside") for c, b in bounds.items()}


def check_range(name: str, df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    return _wide_to_checks(df, _range_rules(name, bounds))


def value_set_difference(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values found but not allowed."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed)).select(column).distinct()


def check_allowed(name: str, df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    extra = value_set_difference(df, column, allowed).agg(F.count("*").cast("double").alias("observed"))
    return extra.select(
        F.lit(f"enum:{name}.{column}").alias("check"), _none().alias("passed"), "observed",
        F.lit("values not allowed").alias("details"),
    )


# --- expectation suites -------------------------------------------------------------------


def expect_suite(df: DataFrame, suite: list[dict]) -> DataFrame:
    """Evaluate a suite of {"type", ...} expectations: all rules on single rows in one aggregate, and each uniqueness
    rule from the number of rows per value, so that no row is repeated for it.

    Types: row_count_between, column_exists, not_null, unique, in_set, between,
    unique_combination. NULL passes in_set, between and unique. An unknown type passes with a
    note.
    """
    rules: dict[str, tuple[Column, Column, str]] = {}
    repeated: list[DataFrame] = []

    def add_repeated(label: str, rows: DataFrame, columns: list[str], details: str) -> None:
        counts = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
        repeated.append(_wide_to_checks(counts, {label: (F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)), _none(), details)}))

    for number, e in enumerate(suite):
        kind, column = e["type"], e.get("column")
        label = f"{number + 1}:{kind}" + (f":{column}" if column else "")
        known = column is None or column in df.columns
        if kind == "row_count_between":
            high = e.get("max_value")
            low_ok = F.col("observed") >= e.get("min_value", 0)
            rules[label] = (F.count("*"), low_ok & (F.col("observed") <= high) if high is not None else low_ok, "rows")
        elif kind == "column_exists":
            rules[label] = (F.max(F.lit(int(known))), F.lit(known), "column")
        elif not known:
            rules[label] = (F.max(F.lit(0)), F.lit(False), "no such column")
        elif kind == "not_null":
            rules[label] = (F.count_if(F.col(column).isNull()), _none(), "NULLs")
        elif kind == "unique":
            add_repeated(label, df.where(F.col(column).isNotNull()), [column], "repeated values")
        elif kind == "unique_combination":
            add_repeated(label, df, e["columns"], "repeated combinations")
        elif kind == "in_set":
            rules[label] = (bad_count(~F.col(column).isin(e["value_set"])), _none(), "values outside the set")
        elif kind == "between":
            low, high = e.get("min_value"), e.get("max_value")
            below = F.col(column) < low if low is not None else F.lit(False)
            above = F.col(column) > high if high is not None else F.lit(False)
            rules[label] = (bad_count(below | above), _none(), "values outside")
        else:
            rules[label] = (F.max(F.lit(0)), F.lit(True), "unknown expectation, skipped")
    parts = ([_wide_to_checks(df, rules)] if rules else []) + repeated
    results = union_checks(parts).orderBy(F.substring_index("check", ":", 1).cast("int"))  # one row per rule
    return results.withColumns(
        {"passed": F.coalesce("passed", F.lit(True)), "observed": F.coalesce("observed", F.lit(0.0))}
    )


def suite_summary(results: DataFrame, suite: str) -> DataFrame:
    return results.agg(
        F.lit(suite).alias("suite"),
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("success"),
    )


# --- tests that return offending rows ---------------------------------------------------------


def freshness_test(df: DataFrame, ts: str, as_of: Column, max_age_hours: float = 24, model: str = "model") -> DataFrame:
    """A row when the newest timestamp is older than allowed."""
    newest = df.agg(F.max(ts).alias("last_update"))
    aged = newest.withColumn("hours_since_update", hours_between(as_of.cast("timestamp"), F.col("last_update").cast("timestamp")))
    return aged.where(F.col("hours_since_update") > max_age_hours).select(F.lit(model).alias("model_name"), "last_update", "hours_since_update")


def min_rows_test(df: DataFrame, min_rows: int = 1, model: str = "model") -> DataFrame:
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.where(F.col("row_count") < min_rows).select(F.lit(model).alias("model_name"), "row_count")


def null_pct_test(df: DataFrame, columns: list[str], max_pct: float = 10, model: str = "model") -> DataFrame:
    """A row per column whose share of NULLs is above the limit."""
    counted = df.agg(F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)])
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_rows")) for i, c in enumerate(columns)]
    )
    rows = counted.select("total_rows", F.inline(cells))
    pct = ratio(F.col("null_rows") * 100, F.col("total_rows"))
    return rows.withColumn("null_percentage", pct).where(F.col("null_percentage") > max_pct).select(
        F.lit(model).alias("model_name"), "column_name", "null_rows", "total_rows", "null_percentage"
    )


def mart_health(marts: dict[str, DataFrame], failed: dict[str, str] | None = None) -> DataFrame:
    """Rows and status per mart: ok, empty, or error for the ones that could not be opened."""
    parts = [
        df.agg(F.lit(n).alias("mart"), F.count("*").alias("row_count")).withColumn(
            "status", F.when(F.col("row_count") > 0, "ok").otherwise("empty")
        )
        for n, df in marts.items()
    ]
    spark = next(iter(marts.values())).sparkSession
    if failed:
        rows = [(n, 0, "error") for n in failed]
        parts.append(spark.createDataFrame(rows, "mart string, row_count bigint, status string"))
    return union_checks(parts)


def quality_report(checks: list[DataFrame]) -> DataFrame:
    """All checks with the share that passed; one row per check, so the window is small."""
    everything = union_checks(checks)
    whole = W.partitionBy()
    passed = F.sum(F.col("passed").cast("int")).over(whole)
    return everything.withColumn("pass_ratio", ratio(passed, F.count("*").over(whole)))


def commerce_checks(tables: dict[str, DataFrame], states: list[str] | None = None) -> list[DataFrame]:
    """The standing checks of the landed commerce tables: NULLs, keys, ranges, value sets."""
    ranges = {
        "reviews": {"review_score": (1, 5)},
        "order_items": {"price": (0, None), "freight_value": (0, None)},
        "payments": {"payment_value": (0, None)},
    }
    checks = [
        _wide_to_checks(df, {**_null_rules(t, fv.REQUIRED_COLUMNS[t]), **_range_rules(t, ranges.get(t, {}))})
        for t, df in tables.items()
    ]
    checks += [
        check_fk(c, tables[c], cc, p, tables[p], pc) for c, cc, p, pc in fv.FOREIGN_KEYS if c in tables and p in tables
    ]
    states = states or [s for group in fv.REGION_STATES.values() for s in group]
    value_sets = [
        ("orders", "order_status", fv.ORDER_STATUSES),
        ("payments", "payment_type", fv.PAYMENT_TYPES),
        ("customers", "customer_state", states),
        ("sellers", "seller_state", states),
    ]
    for table, column, allowed in value_sets:
        if table in tables:
            shown = tables[table].withColumn(column, F.upper(column)) if allowed is states else tables[table]
            checks.append(check_allowed(table, shown, column, allowed))
    return checks
