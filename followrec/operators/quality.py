"""Declarative data-quality checks.

A check is (name, query, expected scalar). `run_checks` evaluates all of
them in one job (only one value per check reaches the driver), then fails on
the first empty result or mismatch, in order; `check_report` gives the same
checks, judged alike, as one lazy DataFrame.

The standard checks of a published table (null keys, stale rows, repeated keys)
are fused: `table_checks` groups a table by its key once and all three counts
are conditional aggregates over the groups, one scan and one shuffle per table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.operators.tables import TABLES, ts_literal
from followrec.params import Params

Query = Union[str, Callable[[SparkSession], DataFrame]]


@dataclass(frozen=True)
class Check:
    name: str
    query: Query
    expected: object


class DataQualityError(ValueError):
    pass


def _frame(spark: SparkSession, q: Query) -> DataFrame:
    return spark.sql(q) if isinstance(q, str) else q(spark)


def _values(spark: SparkSession, checks) -> DataFrame:
    """(_i, _v): position of each check and the first value of its query as text."""
    schema = "_i int, _v string"
    out = spark.createDataFrame([], schema)
    for i, c in enumerate(checks):
        f = _frame(spark, c.query)
        # positional names: a column may be called anything, such as 0.0
        first = f.limit(1).toDF(*[f"c{k}" for k in range(len(f.columns))])
        out = out.unionByName(first.select(F.lit(i).alias("_i"), F.col("c0").cast("string")
                                           .alias("_v")))
    return out


def run_checks(spark: SparkSession, checks, raise_on_fail: bool = True) -> DataFrame:
    """Evaluate checks; returns check_name, actual, expected, passed.

    All checks run in one job: each contributes the first column of its first
    row (a union of one-row branches, so only #checks values reach the
    driver). They are then judged in order and the first empty result or
    mismatch raises.
    """
    checks = list(checks)
    got = {r["_i"]: r["_v"] for r in _values(spark, checks).collect()} if checks else {}
    rows = []
    for i, c in enumerate(checks):
        actual = got.get(i)
        ok = actual is not None and _same(actual, c.expected)
        if not ok and raise_on_fail:
            if i not in got:
                raise DataQualityError(f"check {c.name} returned no results")
            raise DataQualityError(f"check {c.name}: got {actual}, expected {c.expected}")
        rows.append((c.name, actual, str(c.expected), ok))
    return spark.createDataFrame(
        rows, "check_name string, actual string, expected string, passed boolean")


def _same(actual_text: str, expected) -> bool:
    """Value comparison: the text of 0.0 equals 0, the text false equals False only."""
    if isinstance(expected, bool):
        return actual_text.lower() == str(expected).lower()
    if isinstance(expected, (int, float)):
        try:
            return float(actual_text) == expected
        except ValueError:
            return False
    return actual_text == str(expected)


def _same_column(actual: Column, expected) -> Column:
    """`_same` as an expression, for reports that stay lazy."""
    if isinstance(expected, bool):
        return F.lower(actual) == str(expected).lower()
    if isinstance(expected, (int, float)):
        return actual.try_cast("double") == F.lit(float(expected))
    return actual == F.lit(str(expected))


def check_report(spark: SparkSession, checks) -> DataFrame:
    """All checks as one lazy table, judged like `run_checks`: check_name, actual and
    expected as text, passed. A check without a result has no actual value and fails."""
    checks = list(checks)
    rows = spark.createDataFrame([(i, c.name, str(c.expected)) for i, c in enumerate(checks)],
                                 "_i int, check_name string, expected string")
    passed = F.lit(False)
    for i, c in enumerate(checks):
        passed = F.when(F.col("_i") == i, _same_column(F.col("_v"), c.expected)).otherwise(passed)
    return (rows.join(_values(spark, checks), "_i", "left")
            .select("check_name", F.col("_v").alias("actual"), "expected",
                    F.coalesce(passed, F.lit(False)).alias("passed")))


# ---------------------------------------------------------------- standard checks
#: In the order in which they are judged.
STANDARD = ["null_keys", "stale_rows", "duplicate_keys"]


def table_counts(df: DataFrame, keys, params: Params) -> DataFrame:
    """One row with the three counts: rows with a null in a key column, rows updated
    before the expiry cutoff, keys held by more than one row.

    Rows are counted per key first (map-side, so a repeated key is no long
    group), then all checks are conditional sums over the keys.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("updated_at") < ts_literal(params.expiry_cutoff)).alias("_stale"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), zero).alias("null_keys"),
        F.coalesce(F.sum("_stale"), zero).alias("stale_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"))


def table_checks(tables: dict, params: Params) -> DataFrame:
    """The standard checks of all tables: table_name, check, n. One scan per table."""
    parts = []
    for name, df in tables.items():
        counts = table_counts(df, TABLES[name][0], params)
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in STANDARD]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_report(checks: DataFrame) -> DataFrame:
    """check_name, actual, expected, passed of `table_checks`: every count must be 0."""
    return checks.select(F.concat_ws(".", "table_name", "check").alias("check_name"),
                         F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("expected"),
                         (F.col("n") == 0).alias("passed"))


def run_table_checks(tables: dict, params: Params) -> DataFrame:
    """Run the standard checks as one job; the first that fails, in order, raises."""
    rows = table_report(table_checks(tables, params)).collect()
    order = {f"{t}.{c}": i for i, (t, c) in enumerate((t, c) for t in tables for c in STANDARD)}
    for r in sorted(rows, key=lambda r: order[r.check_name]):
        if not r.passed:
            raise DataQualityError(f"check {r.check_name}: got {r.actual}, expected {r.expected}")
    return next(iter(tables.values())).sparkSession.createDataFrame(
        rows, "check_name string, actual bigint, expected bigint, passed boolean")
