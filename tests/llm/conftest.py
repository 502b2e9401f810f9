import os
import shutil

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from delivery_marts.llm.shared import configure

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def batches(spark):
    return configure(spark)


@pytest.fixture(scope="session")
def db():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def texts(db):
    """doc_id -> text of the smallest tables."""
    return dict(db.sql("SELECT doc_id, text FROM documents").fetchall())


def documents(spark, *rows):
    """Rows (doc_id, text), or (doc_id, text, lang, source)."""
    full = [(*row, *(("en", "src1")[len(row) - 2 :] if len(row) < 4 else ()), len(row[1] or "")) for row in rows]
    return spark.createDataFrame(full, DOCUMENTS)


# What every operator on texts has to take: NULLs, empty and long texts, repeated rows and ids.
ODD = [
    (1, "Alpha beta gamma delta."),
    (2, "alpha beta gamma delta."),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "one"),
    (7, "word " * 20_000),
    (8, "x" * 30_000),
    (None, "no id at all"),
    (9, "twice"),
    (9, "twice"),
    (9, "thrice, with another text"),
    (10, "Ünïcode ſtreet — 漢字 wide space \x1c\x85 é ΑΣ ΣΑ"),
]


@pytest.fixture
def odd(spark):
    """Odd documents with columns named like those that operators make."""
    from pyspark.sql import functions as F

    taken = ("score", "shard", "slot", "epoch", "fp", "word", "row", "ids", "cell", "size", "toxic", "_size", "held_out")
    return documents(spark, *ODD).withColumns({name: F.lit("taken") for name in taken})


def own_tables(tmp_path, **tables):
    """A folder of tables like the smallest one, some of them replaced by pyarrow tables."""
    for name in os.listdir(SF_DIR):
        shutil.copy(f"{SF_DIR}/{name}", tmp_path / name)
    for name, table in tables.items():
        os.chmod(tmp_path / f"{name}.parquet", 0o644)
        pq.write_table(table, tmp_path / f"{name}.parquet")
    return str(tmp_path)


def empty_like(name) -> pa.Table:
    return pq.read_table(f"{SF_DIR}/{name}.parquet").slice(0, 0)
