"""Overwriting a database table with a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_ROWS = 10_000


def write_jdbc(
    df: DataFrame, url: str, table: str, connections: int, keep_declaration: bool = True, **options: str
) -> None:
    """Replace the table's rows.

    ``keep_declaration`` truncates, so declared types, keys and indexes stay; without it
    Spark drops the table and makes it anew from the frame's types. ``connections`` bounds
    how many tasks write at once; the rows are shuffled down to that number, as ``coalesce``
    would make the joins before it run in so few tasks too.
    """
    (
        df.repartition(connections)
        .write.format("jdbc")
        .mode("overwrite")
        .options(
            url=url,
            dbtable=table,
            truncate=str(keep_declaration).lower(),
            batchsize=str(BATCH_ROWS),
            **options,
        )
        .save()
    )
