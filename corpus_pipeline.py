"""A corpus from raw documents to packed sequences: toxicity, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; its rows are written and read back
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delivery_marts.llm import mixing, params, queries, simhash, toxicity
from delivery_marts.llm.shared import configure, remainder, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text is below the threshold of the toxicity operator; the rest go.

    Every row is decided by its own score, so a missing or repeated doc_id changes nothing.
    """
    configure(spark)
    held_out = remainder(F.col("doc_id"), params.LABEL_FOLDS) == params.LABEL_HELD_OUT
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    scored = toxicity.toxicity(docs, labels, carried=COLUMNS[1:])
    return scored.where(F.col("score") < params.TOXIC_AT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every SimHash component: the smallest doc_id, rows without doc_id last.

    Components are decided by texts alone: rows of one doc_id whose texts are no copies of each
    other all stay.
    """
    configure(spark)
    order = ("_hash", "lang", "source", "n_chars", "_row")
    numbered = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row"))
    carried = (*COLUMNS[1:], "_row")
    prints = written(simhash.fingerprints(numbered, params.SIMHASH_WORDS, carried), "pipeline-fingerprints")
    rows = prints.withColumn("_hash", F.xxhash64("text")).select("doc_id", "fp", *order)
    placed = rows.join(simhash.classes(prints, params.SIMHASH_RADIUS).select("fp", "component"), "fp")
    same_text = Window.partitionBy("component").orderBy(F.asc_nulls_last("doc_id"), *order)
    first = placed.withColumn("_place", F.row_number().over(same_text)).where("_place = 1").select("_row")
    return prints.join(first, "_row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domain, language and source take them."""
    mixed = mixing.mix(
        docs.select(*COLUMNS), params.mix_domain(), params.MIX_WEIGHTS, params.MIX_EPOCHS, params.MIX_SEED
    )
    return mixed.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 ids."""
    configure(spark)
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Toxicity scores and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None
