"""Data-quality checks on stored tables, all checks of a table in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialweave.functions.areas import AREAS


@dataclass(frozen=True)
class Check:
    """``unique`` (of the non-null values), ``not_null`` or ``accepted_values`` of a column."""

    kind: str
    column: str
    accepted: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


TRIAL_CHECKS = (
    Check("unique", "nct_id"),
    Check("not_null", "nct_id"),
    Check("accepted_values", "therapeutic_area", AREAS),
)
ACTIVITY_CHECKS = (
    Check("not_null", "therapeutic_area"),
    Check("not_null", "update_count"),
)


class QualityError(Exception):
    """Some check found failing rows."""


def _value_counts(df: DataFrame, checks: tuple[Check, ...]) -> tuple[DataFrame, dict[str, int]]:
    """``(column, value, n)`` over the checked columns, and the number each column goes by.

    Every row is read once and unfolded into its checked columns. Counting is pre-aggregated, so a
    frequent value (or null) does not concentrate rows. Columns only checked for null keep no
    values, just null or not.
    """
    numbers = {name: i for i, name in enumerate(dict.fromkeys(check.column for check in checks))}
    by_value = {check.column for check in checks if check.kind != "not_null"}
    cells = []
    for name, number in numbers.items():
        text = F.col(name).cast("string")
        value = text if name in by_value else F.when(text.isNotNull(), "")
        cells.append(F.struct(F.lit(number).alias("column"), value.alias("value")))
    counts = df.select(F.inline(F.array(*cells))).groupBy("column", "value")
    return counts.agg(F.count("*").alias("n")), numbers


def _fails(check: Check, numbers: dict[str, int]) -> Column:
    value = F.col("value")
    failing = {
        "unique": value.isNotNull() & (F.col("n") > 1),
        "not_null": value.isNull(),
        "accepted_values": value.isNotNull() & ~value.isin(*check.accepted),
    }[check.kind]
    return (F.col("column") == numbers[check.column]) & failing


def failing_values(df: DataFrame, check: Check) -> DataFrame:
    """The offending values of one check with their row counts."""
    counts, numbers = _value_counts(df, (check,))
    return counts.filter(_fails(check, numbers)).select("value", "n")


def run_checks(df: DataFrame, checks: tuple[Check, ...], table: str) -> DataFrame:
    """``(table_name, check_name, failures)``: failing values, or failing rows for ``not_null``."""
    counts, numbers = _value_counts(df, checks)

    def failures(check: Check) -> Column:
        fails = _fails(check, numbers)
        if check.kind == "not_null":
            return F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0))
        return F.count_if(fails)

    measures = [failures(check).alias(check.name) for check in checks]
    names = ", ".join(f"'{check.name}', `{check.name}`" for check in checks)
    report = f"stack({len(checks)}, {names}) as (check_name, failures)"
    return counts.agg(*measures).selectExpr(f"'{table}' as table_name", report)


def require_clean(report: DataFrame) -> None:
    """Raise if a check failed; the report holds one row per check."""
    failed = [
        f"{row.table_name}.{row.check_name}: {row.failures}"
        for row in report.filter(F.col("failures") > 0).collect()
    ]
    if failed:
        raise QualityError("; ".join(failed))
