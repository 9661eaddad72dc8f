"""Declarative table checks: rules become Boolean columns, counted in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rhythmica.functions.cleaning import NUMBER, WHOLE_NUMBER
from rhythmica.operators.profile import duplicates


@dataclass(frozen=True)
class Rule:
    """A named condition on one column. ``broken`` builds the Boolean column of offending rows."""

    column: str
    kind: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    low_open: bool = False
    type: str | None = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def broken(self) -> Column:
        c = F.col(self.column)
        number = c.cast("string").try_cast("double")
        if self.kind == "not_null":  # NaN is missing too
            return c.isNull() | F.coalesce(c.cast("string") == "NaN", F.lit(False))
        if self.kind == "between":
            bad = number.isNull() | F.isnan(number)  # a value that is no number is out of range
            if self.low is not None:
                bad = bad | ((number <= self.low) if self.low_open else (number < self.low))
            if self.high is not None:
                bad = bad | (number > self.high)
            return c.isNotNull() & F.coalesce(bad, F.lit(True))
        if self.kind == "in_set":
            return F.coalesce(~c.isin(list(self.values)), F.lit(False))
        if self.kind == "type":
            wrong = c.try_cast(self.type).isNull()
            if self.type in ("tinyint", "smallint", "int", "bigint"):
                wrong = ~c.cast("string").rlike(WHOLE_NUMBER) | wrong
            elif self.type in ("float", "double"):
                wrong = ~c.cast("string").rlike(NUMBER) | wrong
            return c.isNotNull() & wrong
        if self.kind == "finite":
            return F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def between(column: str, low: float | None = None, high: float | None = None, low_open: bool = False) -> Rule:
    return Rule(column, "between", low, high, low_open=low_open)


def in_set(column: str, values: Sequence) -> Rule:
    return Rule(column, "in_set", values=tuple(values))


def of_type(column: str, type_name: str) -> Rule:
    return Rule(column, "type", type=type_name)


# The rule sets of the weekly sales tables.
SALES_COLUMNS = ("Store", "Date", "Weekly_Sales", "Temperature", "Fuel_Price", "Holiday_Flag")
SALES_RULES: tuple[Rule, ...] = (
    *not_null(*SALES_COLUMNS),
    between("Store", 1, 45),
    between("Weekly_Sales", 0),
    between("Temperature", -50, 150),
    between("Fuel_Price", 0, 10, low_open=True),
    in_set("Holiday_Flag", (0, 1)),
    of_type("Date", "timestamp"),
)
FEATURE_COLUMNS = ("Store", "Weekly_Sales", "Weekly_Sales_lag_1", "Weekly_Sales_lag_7", "year", "month", "dayofweek")
FEATURE_RULES: tuple[Rule, ...] = (
    *not_null("Store", "Weekly_Sales"),
    between("Store", 1, 45),
    between("Weekly_Sales", 0),
    between("year", 2000, 2100),
    between("month", 1, 12),
    between("dayofweek", 0, 6),
)
PREDICTION_RULES: tuple[Rule, ...] = (*not_null("predictions"), between("predictions", 0))
REQUEST_COLUMNS = ("Store", "Date")
REQUEST_RULES: tuple[Rule, ...] = (*not_null("Store", "Date"), between("Store", 1, 45), of_type("Date", "timestamp"))
EXPECTATIONS: tuple[Rule, ...] = (
    *not_null("Store"),
    between("Store", 1, 45),
    between("Weekly_Sales", 0),
    in_set("Holiday_Flag", (0, 1)),
)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: number of offending rows and 0/1 success. Every rule is evaluated."""
    counts = df.agg(*[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    cells = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.lit(r.kind).alias("kind"), F.col(f"r{i}").alias("n_failed"))
        for i, r in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*cells)).alias("e")).select("e.*", (F.col("e.n_failed") == 0).cast("int").alias("success"))


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The offending rows with the names of the rules they break."""
    names = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    return df.withColumn("broken_rules", names).filter(F.size("broken_rules") > 0)


def passing(rules: Sequence[Rule]) -> Column:
    """Row filter form of a rule set, for batch and streaming tables."""
    return ~reduce(lambda a, b: a | b, [r.broken() for r in rules])


def summarise(checks: DataFrame) -> DataFrame:
    """Evaluated / successful / unsuccessful counts and the success percentage."""
    n, good = F.count(F.lit(1)), F.sum("success")
    return checks.agg(
        n.alias("evaluated"),
        good.cast("bigint").alias("successful"),
        (n - good).cast("bigint").alias("unsuccessful"),
        (100 * F.try_divide(good, n)).alias("success_percent"),
    )


class ValidationError(ValueError):
    """Raised with the failed checks when a gate is set to stop."""


def check(df: DataFrame, rules: Sequence[Rule], required: Sequence[str] = (), raise_on_failure: bool = True) -> DataFrame:
    """Run a rule set as a gate: returns the checks, or raises naming all that failed."""
    absent = missing_columns(df, required)
    if absent:
        raise ValidationError(f"missing columns: {absent}")
    checks = run_rules(df, rules)
    if raise_on_failure:
        failed = checks.filter("success = 0").collect()  # at most one row per rule
        if failed:
            raise ValidationError("; ".join(f"{r['rule']} ({r['n_failed']} rows)" for r in failed))
    return checks


def check_model_input(df: DataFrame, n_features: int, names: Sequence[str] | None = None, raise_on_failure: bool = True) -> DataFrame:
    """Column count, required names, no null, no infinite value."""
    if len(df.columns) != n_features:
        raise ValidationError(f"expected {n_features} features, found {len(df.columns)}")
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    rules = [*not_null(*df.columns), *[Rule(c, "finite") for c in floats]]
    return check(df, rules, names or (), raise_on_failure)


def quality_report(df: DataFrame, rules: Sequence[Rule], required: Sequence[str] = ()) -> DataFrame:
    """One row: validity, size, null counts per column, duplicate rows, failed checks, time.

    Rules on columns the table lacks are reported as missing columns.
    """
    absent = missing_columns(df, required)
    usable = [r for r in rules if r.column in df.columns]
    nulls = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.count_if(F.col(c).isNull()))])
    failed = [F.struct(F.lit(r.name).alias("rule"), F.count_if(r.broken()).alias("n_failed")) for r in usable]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_counts"), F.array(*failed).alias("_f") if failed else F.array().alias("_f"))
    missing = F.lit(absent) if absent else F.array().cast("array<string>")
    return row.select(
        ((F.size(F.filter("_f", lambda f: f["n_failed"] > 0)) == 0) & (F.size(missing) == 0)).cast("int").alias("is_valid"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        "null_counts",
        duplicates(df).scalar().alias("duplicate_rows"),
        F.filter("_f", lambda f: f["n_failed"] > 0).alias("failures"),
        missing.alias("missing_columns"),
        F.current_timestamp().alias("checked_at"),
    )
