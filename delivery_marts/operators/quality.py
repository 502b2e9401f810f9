"""The fifteen quality checks as one report, and the verdict on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import has_non_digit
from delivery_marts.operators.constraints import dangling_count, union, unique_groups
from delivery_marts.schemas import LINE_GROUP, TABLES, Reference

# Kinds: a table's row count must not be 0, a violation count must be 0.
NOT_EMPTY, NO_VIOLATION = "not_empty", "no_violation"

# The checks' names.
TABLE_COUNTS = {name: f"{name}_count" for name in TABLES}
ORPHANS = {
    "orphan_order_items": ("order_items", Reference("order_id", "orders", "order_id")),
    "orders_without_users": ("orders", Reference("user_id", "users", "user_id")),
    "orders_without_stores": ("orders", Reference("store_id", "stores", "store_id")),
}
REPLACEMENTS = ("order_items", Reference("replaced_by_item_id", "items", "item_id"))
PHONES = {
    "users_non_digit_phones": ("users", "user_phone"),
    "drivers_non_digit_phones": ("drivers", "driver_phone"),
}


class QualityError(ValueError):
    """Some checks failed; the message names them with their values."""


def orphan_check(name: str, child: DataFrame, parent: DataFrame) -> DataFrame:
    """Rows without a parent; a NULL reference has none either."""
    return dangling_count(child, parent, ORPHANS[name][1], keep_null=True)


def invalid_replaced_items(order_items: DataFrame, items: DataFrame) -> DataFrame:
    return dangling_count(order_items, items, REPLACEMENTS[1])


def duplicate_order_item_groups(order_items: DataFrame) -> DataFrame:
    """Line groups that repeat; no replacement and the id that stands for none are the same."""
    spec = TABLES["order_items"]
    return unique_groups(order_items, spec, LINE_GROUP).agg(F.count(F.lit(1)).alias("value"))


def invalid_assignment_dates(assignments: DataFrame) -> DataFrame:
    return assignments.agg(F.count_if(F.col("unassigned_at") < F.col("assigned_at")).alias("value"))


def non_digit_phones(df: DataFrame, phone: str) -> DataFrame:
    return df.agg(F.count_if(has_non_digit(F.col(phone))).alias("value"))


def _named(value: DataFrame, name: str, kind: str) -> DataFrame:
    passed = F.col("value") != 0 if kind == NOT_EMPTY else F.col("value") == 0
    return value.select(
        F.lit(name).alias("check_name"), F.lit(kind).alias("kind"), "value", passed.alias("passed")
    )


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(check_name, kind, value, passed), one row per check.

    Meant for tables on disk: every check scans its own few columns, counts of whole
    tables come from footers, and all checks run as one job.
    """
    checks = [
        _named(tables[table].agg(F.count(F.lit(1)).alias("value")), name, NOT_EMPTY)
        for table, name in TABLE_COUNTS.items()
    ]
    for name, (table, ref) in ORPHANS.items():
        checks.append(_named(orphan_check(name, tables[table], tables[ref.parent]), name, NO_VIOLATION))
    lines, assignments = tables["order_items"], tables["delivery_assignments"]
    others = {
        "invalid_replaced_items": invalid_replaced_items(lines, tables["items"]),
        "duplicate_order_item_groups": duplicate_order_item_groups(lines),
        "invalid_assignment_dates": invalid_assignment_dates(assignments),
        **{name: non_digit_phones(tables[t], phone) for name, (t, phone) in PHONES.items()},
    }
    checks += [_named(value, name, NO_VIOLATION) for name, value in others.items()]
    return union(checks)


def assert_quality(report: DataFrame) -> dict[str, int]:
    """The results by name, or QualityError. A report has fifteen rows."""
    rows = report.collect()
    empty = [r.check_name for r in rows if not r.passed and r.kind == NOT_EMPTY]
    failed = {r.check_name: r.value for r in rows if not r.passed and r.kind == NO_VIOLATION}
    if empty or failed:
        raise QualityError(f"quality checks failed; empty tables: {empty}; violations: {failed}")
    return {r.check_name: r.value for r in rows}
