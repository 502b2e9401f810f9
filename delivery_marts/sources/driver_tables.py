"""An order-line feed made from TPC-H-like tables.

The same mapping is written once for Spark and for the SQL the results are compared
with; :class:`Dialect` holds the two things the engines spell differently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_marts.operators.ordering import FILE, ROW, ROW_BITS
from delivery_marts.schemas import RAW_FEED

TABLES_READ = ("lineitem", "orders", "customer", "nation", "region")


@dataclass(frozen=True)
class Dialect:
    timestamp: str  # type of a timestamp without zone
    row: str  # function that makes a comparable row value


SPARK = Dialect(timestamp="TIMESTAMP_NTZ", row="struct")
DUCKDB = Dialect(timestamp="TIMESTAMP", row="row")

COLUMNS_TEMPLATE = """
SELECT
  CAST(o_orderkey AS INT) AS order_id,
  CAST(o_custkey AS INT) AS user_id,
  CASE (o_custkey + l_linenumber) % 4
    WHEN 0 THEN '8 (900) ' || lpad(CAST(o_custkey AS VARCHAR(20)), 7, '0')
    WHEN 1 THEN '+7-900-' || lpad(CAST(o_custkey AS VARCHAR(20)), 7, '0')
    WHEN 2 THEN '900' || lpad(CAST(o_custkey AS VARCHAR(20)), 7, '0')
    ELSE 'n/a' END AS user_phone,
  CAST(o_orderkey % 5 AS INT) AS store_id,
  s.r_name || ', store ' || CAST(l_linenumber % 3 AS VARCHAR(20)) AS store_address,
  CASE WHEN l_suppkey % 10 <> 9 THEN CAST(l_suppkey AS INT) END AS driver_id,
  '8' || lpad(CAST(l_suppkey AS VARCHAR(20)), 10, '9') AS driver_phone,
  CAST(l_partkey % 50 AS INT) AS item_id,
  'item ' || CAST(l_partkey % 50 AS VARCHAR(20)) AS item_title,
  'cat ' || CAST(l_partkey % 7 AS VARCHAR(20)) AS item_category,
  u.r_name || ', st ' || CAST(o_custkey AS VARCHAR(20)) AS address_text,
  {t[10:00:00]} AS created_at,
  CASE WHEN o_orderkey % 10 <> 0 THEN {t[10:05:00]} END AS paid_at,
  CASE WHEN o_orderkey % 10 > 1
    THEN {t[10:30:00]} + (l_linenumber % 2) * INTERVAL '10' MINUTE END AS delivery_started_at,
  CASE WHEN o_orderkey % 10 > 3 AND l_linenumber % 4 <> 1 THEN {t[11:30:00]} END AS delivered_at,
  CASE WHEN o_orderkey % 10 = 9 THEN {t[12:00:00]}
    WHEN o_orderkey % 10 = 3 THEN {t[10:35:00]} END AS canceled_at,
  o_orderpriority AS payment_type,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 4 * 5 AS INT) END AS order_discount,
  CASE WHEN o_orderkey % 10 IN (3, 9) THEN
    CASE o_orderkey % 3 WHEN 0 THEN 'Ошибка приложения' WHEN 1 THEN 'Проблемы с оплатой'
    ELSE 'other' END END AS order_cancellation_reason,
  CAST(o_orderkey % 300 AS INT) AS delivery_cost,
  CASE WHEN l_quantity < 50 THEN CAST(100 + l_partkey % 50 AS INT) END AS item_price,
  CASE WHEN l_discount > 0.05 THEN 10 ELSE 0 END AS item_discount,
  CASE WHEN l_returnflag = 'A' AND l_linenumber = 7
    THEN CAST((l_partkey + 1) % 53 AS INT) END AS item_replaced_id,
  CAST(l_quantity AS INT) AS item_quantity,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) % 5
    WHEN l_returnflag = 'A' THEN 0 END AS item_canceled_quantity,
  l_linenumber % 3 AS file_no,
"""
ROW_ORDER = """l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
    l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"""
FROM_TEMPLATE = """
FROM {tables[lineitem]}
JOIN {tables[orders]} ON l_orderkey = o_orderkey
JOIN {tables[customer]} ON o_custkey = c_custkey
JOIN {tables[nation]} n ON c_nationkey = n_nationkey
JOIN {tables[region]} u ON n_regionkey = u.r_regionkey
JOIN {tables[region]} s ON o_orderkey % 5 = s.r_regionkey
"""


class _Times(dict):
    """Hour of an order's own day, as SQL."""

    def __init__(self, dialect: Dialect) -> None:
        super().__init__()
        self.dialect = dialect

    def __missing__(self, hour: str) -> str:
        start = f"CAST('2024-01-01 {hour}' AS {self.dialect.timestamp})"
        return f"{start} + (o_orderkey % 28) * INTERVAL '1' DAY"


def feed_sql(dialect: Dialect, tables: dict[str, str]) -> str:
    template = f"{COLUMNS_TEMPLATE}  {{row}}({ROW_ORDER}) AS row_no{FROM_TEMPLATE}"
    return template.format_map({"t": _Times(dialect), "row": dialect.row, "tables": tables})


def _frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES_READ}


def read_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapped feed: raw columns in contract order, then the two ordinals."""
    sql = feed_sql(SPARK, {name: f"{{{name}}}" for name in TABLES_READ})
    return spark.sql(sql, **_frames(spark, sf_dir)).select(*RAW_FEED.names, F.col(FILE).cast("bigint"), ROW)


# Low bits of a row's ordinal count rows of one sorted range, the others ranges; together they fit
# the bits that an ordinal has beside the file number.
RANGE_BITS = 28


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with the place of their ``ROW_ORDER`` as a bigint, sorted in ranges of that order.

    The places rise with the order but are not dense. Lines equal in all those columns are the same
    line, so which of them comes first decides nothing.
    """
    order = [name.strip() for name in ROW_ORDER.split(",")]
    place = F.monotonically_increasing_id()
    inside = place.bitwiseAND(F.lit((1 << 33) - 1))
    packed = F.shiftleft(F.shiftright(place, 33), RANGE_BITS) + inside
    fits = (inside < 1 << RANGE_BITS) & (F.shiftright(place, 33) < 1 << (ROW_BITS - RANGE_BITS))
    checked = F.when(fits, packed).otherwise(F.raise_error(F.lit("more lines than ordinals have bits for")))
    return lines.select(*order).orderBy(*order).withColumn("l_row", checked.cast("bigint"))


def store_feed(spark: SparkSession, sf_dir: str, path: str, columns: Sequence[str] = RAW_FEED.names) -> DataFrame:
    """The rows of ``read_feed``, written once and read back, for plans that read them often.

    Rows are numbered inside their files as parquet readers number them, by a bigint, in the order
    of ``read_feed``. Orders meet their customers before their lines, so lines are shuffled by order
    only, however large the other tables are.
    """
    frames = _frames(spark, sf_dir)
    lines = _numbered(frames["lineitem"])
    placed = spark.sql(
        """SELECT o.*, n.n_regionkey FROM {orders} o JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} n ON c_nationkey = n_nationkey""",
        **frames,
    )
    sql = COLUMNS_TEMPLATE + """  l_row AS row_no
FROM {lines} JOIN {placed} ON l_orderkey = o_orderkey
JOIN {region} u ON n_regionkey = u.r_regionkey
JOIN {region} s ON o_orderkey % 5 = s.r_regionkey"""
    names = ("lines", "placed", "region")
    tables = {"lines": lines, "placed": placed, "region": frames["region"]}
    texts = {"t": _Times(SPARK), **{name: f"{{{name}}}" for name in names}}
    feed = spark.sql(sql.format_map(texts), **tables)
    feed = feed.select(*columns, F.col(FILE).cast("bigint"), ROW)
    feed.write.mode("overwrite").parquet(path)
    return spark.read.schema(feed.schema).parquet(path)
