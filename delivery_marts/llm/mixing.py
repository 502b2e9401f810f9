"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree: domain, language, source. A budget of tokens goes down the tree. At
every node it is shared among the children by their weights; a child whose subtree cannot use
its share (all its tokens times the allowed epochs) takes what it can, and what it leaves goes
to its siblings. Since a node never receives more than its subtree can use, a shortage is met
by siblings first and reaches the parent's siblings only once they are exhausted.

A leaf with quota q and t tokens of its own gives q div t whole epochs and then the first
tokens of one more: its documents in the order of md5(seed, epoch, doc_id), as far as they
begin before the rest of the quota. That prefix is found without sorting a leaf in one task:
tokens are summed in 4096 slices of the hash, the slice in which the quota ends is known from
their running sum, and only that slice is ordered. What results is one cut hash per leaf, so
the documents themselves are filtered and never shuffled.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Defined results: NULL domain, language or source is a
branch named ``unknown``; a NULL or empty text has no tokens and goes with its place in the
order; rows that repeat a doc_id are taken or left together; a branch without a declared weight
has the given default; weight 0 gives nothing; an empty table gives an empty one. All arithmetic
is in integers, so results do not depend on the order of rows. All input columns
are returned as they are, whatever their names; only one called ``epoch`` is replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delivery_marts.llm.shared import written

LEVELS = ("domain", "lang", "source")
UNKNOWN = "unknown"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_DIGITS = 3  # of the hash: 16 ** 3 slices

Weights = Mapping[str, int]


def _weight(level: str, weights: Mapping[str, Weights], default: int) -> Column:
    value = F.lit(default).cast("bigint")
    for name, weight in weights.get(level, {}).items():
        value = F.when(F.col(level) == name, F.lit(weight).cast("bigint")).otherwise(value)
    return value


def water_fill(children: DataFrame, parent: list[str]) -> DataFrame:
    """Shares ``_given`` of each parent among its children as ``_quota``.

    Columns needed: ``_cap`` (what a child can use, 0 if its weight is 0), ``_weight``, and
    ``_given``, equal for all children of a parent and at most the sum of their caps. In the
    order of cap per weight, a child is full if its cap is at most its share of what the
    children before it have left; from the first that is not, all share alike.
    """
    wide = "decimal(38,0)"
    group = Window.partitionBy(*parent)
    order = group.orderBy((F.col("_cap") / F.nullif("_weight", F.lit(0))).asc_nulls_last(), F.col("_name"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("_given") - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    shared = children.withColumns(
        {"_left": left, "_weights": F.sum("_weight").over(onward), "_place": F.row_number().over(order)}
    ).withColumn(
        "_full",
        F.col("_cap").cast(wide) * F.col("_weights") <= F.col("_weight").cast(wide) * F.col("_left"),
    )
    first = F.min(F.when(~F.col("_full"), F.struct("_place", "_left", "_weights"))).over(group)
    return (
        shared.withColumn("_first", first)
        .withColumn(
            "_quota",
            F.when(F.col("_full") & (F.col("_first").isNull() | (F.col("_place") < F.col("_first._place"))), F.col("_cap"))
            .when(F.col("_weight") == 0, F.lit(0))
            .otherwise(
                F.expr(f"(cast(_weight AS {wide}) * _first._left) div nullif(_first._weights, 0)")
            )
            .cast("bigint"),
        )
        .drop("_left", "_weights", "_place", "_full", "_first")
    )


def leaf_quotas(
    leaves: DataFrame,
    weights: Mapping[str, Weights],
    epochs: int,
    budget: int | None = None,
    default_weight: int = 1,
) -> DataFrame:
    """Quotas of tokens for leaves (domain, lang, source, _tokens), level by level."""
    level_weights = [_weight(level, weights, default_weight).alias(f"_w{i}") for i, level in enumerate(LEVELS)]
    nodes = leaves.select(*LEVELS, "_tokens", *level_weights)
    # A branch of weight 0 anywhere on its path can use nothing.
    usable = F.when((F.col("_w0") > 0) & (F.col("_w1") > 0) & (F.col("_w2") > 0), F.col("_tokens") * epochs)
    nodes = nodes.withColumn("_cap", F.coalesce(usable, F.lit(0)))
    total = nodes.agg(F.sum("_cap").alias("_all"), F.sum("_tokens").alias("_available"))
    wanted = F.lit(budget).cast("bigint") if budget is not None else F.col("_available")
    given = total.select(F.lit("").alias("_root"), F.least("_all", wanted).alias("_given"))
    parent: list[str] = ["_root"]
    for depth, level in enumerate(LEVELS):
        path = [*parent, level]
        below = nodes.withColumn("_root", F.lit("")).groupBy(*path).agg(
            F.sum("_cap").alias("_cap"), F.max(f"_w{depth}").alias("_weight"), F.sum("_tokens").alias("_tokens")
        )
        shared = water_fill(below.withColumn("_name", F.col(level)).join(given, parent), parent)
        given = shared.select(*path, F.col("_quota").alias("_given"), "_tokens")
        parent = path
        if depth < len(LEVELS) - 1:
            given = given.drop("_tokens")
    return given.drop("_root").withColumnRenamed("_given", "_quota")


def _order_key(seed: int) -> Column:
    """Place of a document in the epoch after its leaf's whole ones."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), F.col("doc_id").cast("string")).cast("binary"))


def leaf_cuts(sizes: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """Per leaf: whole epochs, and the last hash taken in the epoch after those (or NULL)."""
    plans = quotas.select(
        *LEVELS,
        F.when(F.col("_tokens") > 0, F.expr("_quota div _tokens")).otherwise(F.lit(0)).alias("_whole"),
        F.when(F.col("_tokens") > 0, F.expr("_quota % _tokens")).otherwise(F.lit(0)).alias("_rest"),
    )
    keyed = (
        sizes.join(plans, list(LEVELS))
        .where("_rest > 0")
        .withColumn("_key", _order_key(seed))
        .withColumn("_slice", F.substring("_key", 1, SLICE_DIGITS))
    )
    slices = keyed.groupBy(*LEVELS, "_slice", "_rest").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy(*LEVELS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        slices.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .where("_before < _rest")
        .groupBy(*LEVELS)
        .agg(F.max(F.struct("_slice", "_before")).alias("_end"))
        .select(*LEVELS, F.col("_end._slice").alias("_slice"), F.col("_end._before").alias("_before"))
    )
    # Rows that repeat a doc_id share a key and are cut together.
    ordered = Window.partitionBy(*LEVELS).orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        keyed.join(ends, [*LEVELS, "_slice"])
        .groupBy(*LEVELS, "_key", "_rest", "_before")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn("_start", F.col("_before") + F.coalesce(F.sum("_sum").over(ordered), F.lit(0)))
        .where("_start < _rest")
        .groupBy(*LEVELS)
        .agg(F.max("_key").alias("_cut"))
    )
    return plans.drop("_rest").join(last, list(LEVELS), "left")


def with_leaf(documents: DataFrame, domain: Column) -> DataFrame:
    """The rows as ``given``, and what is needed of them: NULL names are ``unknown``."""
    return documents.select(
        F.struct("*").alias("given"),
        "doc_id",
        F.coalesce(domain, F.lit(UNKNOWN)).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit(UNKNOWN)).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("_size"),
    )


def mix(
    documents: DataFrame,
    domain: Column,
    weights: Mapping[str, Weights],
    epochs: int,
    seed: int = 0,
    budget: int | None = None,
    default_weight: int = 1,
) -> DataFrame:
    """Documents (doc_id, text, lang, source, …) as often as their leaf's quota takes them.

    Returns the given columns and ``epoch``, from 0; a document taken in several epochs has a
    row for each. ``budget`` is in tokens; without one it is what the input holds.
    """
    placed = with_leaf(documents, domain)
    sizes = written(placed.drop("given"), "mixing-sizes")
    leaves = sizes.groupBy(*LEVELS).agg(F.sum("_size").alias("_tokens"))
    quotas = leaf_quotas(leaves, weights, epochs, budget, default_weight)
    cuts = written(leaf_cuts(sizes, quotas, seed), "mixing-cuts")
    taken = placed.drop("_size").join(cuts, list(LEVELS))
    more = F.coalesce(_order_key(seed) <= F.col("_cut"), F.lit(False)).cast("bigint")
    copies = taken.withColumn("_copies", (F.col("_whole") + more).cast("int")).where("_copies > 0")
    epoch = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    kept = [F.col(f"given.`{c}`") for c in documents.columns if c != "epoch"]
    return copies.withColumn("epoch", epoch).select(*kept, "epoch")
