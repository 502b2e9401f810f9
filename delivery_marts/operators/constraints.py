"""Declared constraints as frames of violating rows, and as counts.

``violations`` names every offending row; ``violation_counts`` only counts, and so can
reduce before each shuffle. A load is decided by the counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.schemas import BUCKETS, Reference, TableSpec

NOT_NULL, LENGTH, CHECK = "not_null", "length", "check"
PRIMARY_KEY, UNIQUE, FOREIGN_KEY = "primary_key", "unique", "foreign_key"


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def row_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, Column, Column]]:
    """(kind, constraint, violated, detail) of every rule a single row can break."""
    rules = []
    for f in spec.schema:
        if f.name not in df.columns:
            continue
        value = F.col(f.name)
        if not f.nullable:
            rules.append((NOT_NULL, f"{f.name}_not_null", value.isNull(), F.lit("NULL")))
        if isinstance(f.dataType, T.VarcharType):
            length = F.length(value)
            too_long = F.coalesce(length > f.dataType.length, F.lit(False))
            rules.append((LENGTH, f"{f.name}_length", too_long, length.cast("string")))
    for name, predicate in spec.checks.items():
        rules.append((CHECK, name, ~F.coalesce(F.expr(predicate), F.lit(True)), F.lit(predicate)))
    return rules


def _violation(spec: TableSpec, kind: Column, name: Column, key: Column, detail: Column) -> list[Column]:
    return [
        F.lit(spec.name).alias("table_name"),
        kind.alias("kind"),
        name.alias("constraint_name"),
        key.alias("row_key"),
        detail.alias("detail"),
    ]


BROKEN_RULES = "array<struct<kind:string,constraint_name:string,detail:string>>"


def row_violations(df: DataFrame, spec: TableSpec, *kinds: str) -> DataFrame:
    """All row-level violations of the given kinds (default: all) in one pass."""
    broken = F.array(
        *[
            F.when(violated, F.struct(F.lit(kind), F.lit(name), detail))
            for kind, name, violated, detail in row_rules(df, spec)
            if not kinds or kind in kinds
        ]
    ).cast(BROKEN_RULES)
    key = key_text(_present(df, spec.natural_key))
    found = df.select(
        key.alias("row_key"), F.explode(F.filter(broken, lambda rule: rule.isNotNull())).alias("rule")
    )
    kind, name, detail = (F.col(f"rule.{part}") for part in ("kind", "constraint_name", "detail"))
    return found.select(*_violation(spec, kind, name, F.col("row_key"), detail))


def _repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; NULLs are equal here. Partial counts go first, so
    one much-repeated key costs a row per task."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_groups(df: DataFrame, spec: TableSpec, columns: Sequence[str]) -> DataFrame:
    """Repeated groups of a unique index, with the values that it holds for NULLs."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in spec.unique_nulls.items() if c in columns}
    return _repeated(df.withColumns(filled), columns)


def primary_key_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that repeat or hold a NULL, with the number of rows that carry them."""
    columns = _present(df, spec.primary_key)
    has_null = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    keys = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | has_null)
    return keys.select(
        *_violation(
            spec, F.lit(PRIMARY_KEY), F.lit(f"{spec.name}_pkey"), key_text(columns), F.col("n").cast("string")
        )
    )


def unique_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Groups of a unique index that repeat, by the values the index holds."""
    return union(
        [
            unique_groups(df, spec, columns).select(
                *_violation(spec, F.lit(UNIQUE), F.lit(name), key_text(columns), F.col("n").cast("string"))
            )
            for name, columns in spec.unique.items()
        ]
    )


def dangling(child: DataFrame, parent: DataFrame, ref: Reference, keep_null: bool = False) -> DataFrame:
    """Child rows whose reference is not in the parent.

    An anti join with the child on the left, where a hot key can be split. A NULL
    reference is no violation of a foreign key; ``keep_null`` counts it all the same.
    """
    rows = child if keep_null else child.where(F.col(ref.column).isNotNull())
    keys = parent.select(F.col(ref.parent_key).alias(ref.column))
    return rows.join(keys, ref.column, "left_anti")


def _stored_together(child: DataFrame, parent: DataFrame, ref: Reference) -> bool:
    """Both sides lie in as many buckets of the reference, so that they meet without a shuffle."""
    buckets, others = (
        df.schema[column].metadata.get(BUCKETS) for df, column in ((child, ref.column), (parent, ref.parent_key))
    )
    return buckets is not None and buckets == others


def _word(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), 6)


def _bit(key: Column) -> Column:
    place = key.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def key_words(df: DataFrame, column: str) -> DataFrame:
    """The distinct integers of a column as an exact bitmap: (word, bits), one row for each run of
    64 numbers that has any. NULLs are in no word; negative numbers are as good as others."""
    key = F.col(column)
    words = df.where(key.isNotNull()).select(_word(key).alias("word"), _bit(key).alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def missing_words(child: DataFrame, parent: DataFrame, ref: Reference) -> DataFrame:
    """References that the parent lacks, as (word, lost): the child's bits without the parent's."""
    held = key_words(parent, ref.parent_key).withColumnRenamed("bits", "held")
    lost = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("held", F.lit(0).cast("bigint"))))
    return key_words(child, ref.column).join(held, "word", "left").select("word", lost.alias("lost")).where("lost != 0")


def dangling_count(child: DataFrame, parent: DataFrame, ref: Reference, keep_null: bool = False) -> DataFrame:
    """How many rows ``dangling`` has, as one row ``value``.

    The child is counted per reference before an anti join, so what is shuffled and joined is the
    distinct references, not the rows. Integer references that are not stored in buckets are first
    compared as bitmaps, which shuffles a row per 64 neighbouring numbers; only from the first
    lost word on are both columns then read again and references joined. Where nothing is lost,
    that is beyond what any file's statistics reach.
    """
    whole = all(
        isinstance(df.schema[column].dataType, T.IntegralType)
        for df, column in ((child, ref.column), (parent, ref.parent_key))
    )
    if whole and not _stored_together(child, parent, ref):
        words = missing_words(child, parent, ref)
        first = words.agg(F.coalesce(F.min("word") * 64, F.lit(2**63 - 1))).scalar()
        key = F.col(ref.column)
        child = child.where((key >= first) | key.isNull() if keep_null else key >= first)
        parent = parent.where(F.col(ref.parent_key) >= first)
    per_key = child.groupBy(ref.column).agg(F.count(F.lit(1)).alias("n"))
    lost = dangling(per_key, parent, ref, keep_null)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value"))


def foreign_key_name(spec: TableSpec, ref: Reference) -> str:
    return f"{spec.name}_{ref.column}_fkey"


def foreign_key_violations(child: DataFrame, spec: TableSpec, parents: dict[str, DataFrame]) -> DataFrame:
    return union(
        [
            dangling(child, parents[ref.parent], ref).select(
                *_violation(
                    spec,
                    F.lit(FOREIGN_KEY),
                    F.lit(foreign_key_name(spec, ref)),
                    key_text(_present(child, spec.natural_key)),
                    F.col(ref.column).cast("string"),
                )
            )
            for ref in spec.references
        ]
    )


def violations(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """Every violation: (table_name, kind, constraint_name, row_key, detail)."""
    frames = []
    for name, spec in specs.items():
        df = tables[name]
        frames.append(row_violations(df, spec))
        if _present(df, spec.primary_key):
            frames.append(primary_key_violations(df, spec))
        if spec.unique:
            frames.append(unique_violations(df, spec))
        if spec.references:
            frames.append(foreign_key_violations(df, spec, tables))
    return union(frames)


def _count(frame: DataFrame, spec: TableSpec, kind: str, name: str) -> DataFrame:
    return frame.select(
        F.lit(spec.name).alias("table_name"),
        F.lit(kind).alias("kind"),
        F.lit(name).alias("constraint_name"),
        F.col("value").alias("violations"),
    )


def row_rule_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Counts of all row-level rules of a table from a single scan, without a shuffle
    beyond the one partial row per task."""
    rules = row_rules(df, spec)
    counted = df.agg(*[F.count_if(violated).alias(name) for _, name, violated, _ in rules])
    rows = F.array(
        *[
            F.struct(
                F.lit(spec.name).alias("table_name"),
                F.lit(kind).alias("kind"),
                F.lit(name).alias("constraint_name"),
                F.col(name).alias("violations"),
            )
            for kind, name, _, _ in rules
        ]
    )
    return counted.select(F.inline(rows))


ROWS = "rows"


class RowRules:
    """The row-level rules of a table, and its rows, counted while the table is written.

    The counts come with the write, as observed metrics: no scan of their own. They are exact if
    the observed frame is the one that the writing tasks go through, as Spark takes the metrics of
    each such task once, also where it ran twice.
    """

    def __init__(self, spec: TableSpec):
        self.spec = spec
        self._observation = Observation(f"rules of {spec.name}")

    def observe(self, df: DataFrame) -> DataFrame:
        self.rules = row_rules(df, self.spec)
        broken = [F.count_if(violated).alias(name) for _, name, violated, _ in self.rules]
        return df.observe(self._observation, F.count(F.lit(1)).alias(ROWS), *broken)

    @property
    def rows(self) -> int:
        """How many rows were written; waits for the write."""
        return self._observation.get[ROWS]

    @property
    def counts(self) -> list[tuple[str, str, str, int]]:
        """(table, kind, constraint, violations) as ``row_rule_counts`` gives them."""
        found = self._observation.get
        return [(self.spec.name, kind, name, found[name]) for kind, name, _, _ in self.rules]

    def record(self) -> dict:
        """Both, to be kept until all tables are written."""
        return {"rows": self.rows, "counts": self.counts}


def _reference_counts(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> list[DataFrame]:
    return [
        _count(dangling_count(tables[name], tables[ref.parent], ref), spec, FOREIGN_KEY, foreign_key_name(spec, ref))
        for name, spec in specs.items()
        for ref in spec.references
    ]


def reference_counts(tables: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """One row per foreign key: how many rows break it."""
    return union(_reference_counts(tables, specs))


def violation_counts(
    tables: dict[str, DataFrame], specs: dict[str, TableSpec], keys: bool = True
) -> DataFrame:
    """One row per declared constraint: how many rows, or keys, break it.

    ``keys=False`` leaves out primary keys and unique groups, which cost a shuffle of the
    whole table each, for tables that are unique by the way they were made.
    """
    frames = []
    for name, spec in specs.items():
        df = tables[name]
        frames.append(row_rule_counts(df, spec))
        if keys and _present(df, spec.primary_key):
            repeated = primary_key_violations(df, spec).agg(F.count(F.lit(1)).alias("value"))
            frames.append(_count(repeated, spec, PRIMARY_KEY, f"{spec.name}_pkey"))
        for index, columns in spec.unique.items() if keys else ():
            groups = unique_groups(df, spec, columns).agg(F.count(F.lit(1)).alias("value"))
            frames.append(_count(groups, spec, UNIQUE, index))
    return union([*frames, *_reference_counts(tables, specs)])
