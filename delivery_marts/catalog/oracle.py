"""SQL that gives each named query's result by another road.

Window functions stand against ``min_by`` aggregates, naive joins of all lines against
sums taken before the join, COUNT(DISTINCT) against two-step grouping, NOT EXISTS
against anti joins on distinct keys.
"""

from __future__ import annotations

from delivery_marts.sources.driver_tables import DUCKDB, TABLES_READ, feed_sql

HEADER = (
    "user_id", "store_id", "address_text", "created_at", "paid_at", "delivery_started_at",
    "delivered_at", "canceled_at", "payment_type", "order_discount",
    "order_cancellation_reason", "delivery_cost",
)

STATUS = """CASE WHEN canceled_at IS NOT NULL THEN 'canceled'
  WHEN delivered_at IS NOT NULL THEN 'delivered'
  WHEN delivery_started_at IS NOT NULL THEN 'in_delivery'
  WHEN paid_at IS NOT NULL THEN 'paid' ELSE 'created' END"""

CELL = "year, month, day, city, store_id, item_category, item_id, item_title"


def _phone(column: str) -> str:
    digits = f"regexp_replace({column}, '[^0-9]', '', 'g')"
    return f"""CASE WHEN {digits} = '' THEN NULL
      WHEN length({digits}) = 11 AND substr({digits}, 1, 1) = '8' THEN '7' || substr({digits}, 2)
      ELSE {digits} END"""


def _dimension(key: str, columns: str) -> str:
    return f"""SELECT {key}, {columns} FROM feed WHERE {key} IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY file_no DESC, row_no) = 1"""


_first = ",\n  ".join(f"first_value({c} IGNORE NULLS) OVER w AS {c}" for c in HEADER)

BASE = f"""
WITH feed AS ({feed_sql(DUCKDB, {name: name for name in TABLES_READ})}),
raw_users AS ({_dimension("user_id", "user_phone")}),
raw_drivers AS ({_dimension("driver_id", "driver_phone")}),
users_t AS (SELECT user_id, {_phone("user_phone")} AS user_phone FROM raw_users),
stores_t AS ({_dimension("store_id", "store_address")}),
drivers_t AS (SELECT driver_id, {_phone("driver_phone")} AS driver_phone FROM raw_drivers),
items_t AS ({_dimension("item_id", "item_title, item_category")}),
headers AS (
  SELECT DISTINCT file_no, order_id,
  {_first}
  FROM feed
  WINDOW w AS (PARTITION BY file_no, order_id ORDER BY row_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
orders_t AS (
  SELECT order_id, {", ".join(HEADER)}, {STATUS} AS status FROM headers
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY file_no) = 1
),
file_lines AS (
  SELECT file_no, order_id, item_id, item_price, item_discount,
    NULLIF(coalesce(item_replaced_id, -1), -1) AS replaced_by_item_id,
    CAST(coalesce(sum(item_quantity), 0) AS BIGINT) AS item_quantity,
    CAST(coalesce(sum(item_canceled_quantity), 0) AS BIGINT) AS item_canceled_quantity
  FROM feed
  WHERE order_id IS NOT NULL AND item_id IS NOT NULL AND item_price IS NOT NULL
    AND item_discount IS NOT NULL
  GROUP BY ALL
),
lines_t AS (
  SELECT order_id, item_id, item_price, item_discount, replaced_by_item_id,
    CAST(sum(item_quantity) AS BIGINT) AS item_quantity,
    CAST(sum(item_canceled_quantity) AS BIGINT) AS item_canceled_quantity
  FROM file_lines GROUP BY ALL
),
history AS (
  SELECT DISTINCT file_no, order_id, driver_id, delivery_started_at FROM feed
  WHERE driver_id IS NOT NULL AND delivery_started_at IS NOT NULL
),
intervals AS (
  SELECT file_no, d.order_id, driver_id, d.delivery_started_at AS assigned_at,
    CASE WHEN h.delivered_at IS NOT NULL THEN h.delivered_at ELSE h.canceled_at END AS unassigned_at
  FROM history d LEFT JOIN headers h USING (file_no, order_id)
),
assignments_t AS (
  SELECT DISTINCT order_id, driver_id, assigned_at, unassigned_at FROM intervals
  WHERE NOT coalesce(unassigned_at < assigned_at, false)
),
current_t AS (
  SELECT order_id, max(driver_id) AS driver_id FROM assignments_t
  WHERE unassigned_at IS NULL GROUP BY order_id
),
order_rows AS (
  SELECT o.*, d.driver_id, i.item_quantity AS q, i.item_canceled_quantity AS c,
    i.item_price AS p, i.item_discount AS id
  FROM orders_t o LEFT JOIN lines_t i ON o.order_id = i.order_id
  LEFT JOIN current_t d ON o.order_id = d.order_id
  LEFT JOIN stores_t s ON o.store_id = s.store_id
),
orders_exact AS (
  SELECT order_id, user_id, store_id, driver_id, status, order_cancellation_reason,
    created_at, address_text, delivered_at, canceled_at,
    CAST(sum(q * p * (100 - id) * (100 - order_discount)) AS BIGINT) AS cash_exact,
    CAST(sum(CASE WHEN status = 'canceled' THEN 0
      ELSE (q - c) * p * (100 - id) * (100 - order_discount) END) AS BIGINT) AS revenue_exact
  FROM order_rows GROUP BY ALL
),
orders_mart_t AS (
  SELECT order_id, user_id, store_id, driver_id,
    CAST(cash_exact AS DOUBLE) / 10000 AS cash_flows,
    CAST(revenue_exact AS DOUBLE) / 10000 AS revenue, status, order_cancellation_reason,
    CASE WHEN status = 'canceled' AND (order_cancellation_reason = 'Ошибка приложения'
      OR order_cancellation_reason = 'Проблемы с оплатой') THEN 1 ELSE 0 END AS is_cancel_error,
    CASE WHEN delivered_at IS NOT NULL AND canceled_at IS NOT NULL
      AND canceled_at > delivered_at THEN 1 ELSE 0 END AS is_cancel_after_delivery,
    split_part(address_text, ',', 1) AS city, CAST(year(created_at) AS INT) AS year,
    CAST(month(created_at) AS INT) AS month, CAST(day(created_at) AS INT) AS day
  FROM orders_exact
),
item_rows AS (
  SELECT o.order_id, o.store_id, CAST(strftime(created_at, '%Y') AS INT) AS year,
    CAST(strftime(created_at, '%m') AS INT) AS month, CAST(strftime(created_at, '%d') AS INT) AS day,
    split_part(address_text, ',', 1) AS city, l.item_id, item_category, item_title,
    item_quantity AS q, item_canceled_quantity AS c, item_price AS p, item_discount AS id
  FROM orders_t o LEFT JOIN lines_t l ON o.order_id = l.order_id
  LEFT JOIN items_t i ON l.item_id = i.item_id
  LEFT JOIN stores_t s ON o.store_id = s.store_id
),
items_exact AS (
  SELECT {CELL}, CAST(sum(q * p * (100 - id)) AS BIGINT) AS cash_exact,
    CAST(sum(q) AS BIGINT) AS ordered_qty, CAST(sum(c) AS BIGINT) AS canceled_qty,
    count(DISTINCT order_id) AS orders_cnt,
    count(DISTINCT CASE WHEN c > 0 THEN order_id END) AS orders_with_canceled_items
  FROM item_rows GROUP BY {CELL}
),
items_mart_t AS (
  SELECT store_id, item_category, item_id, item_title,
    CAST(cash_exact AS DOUBLE) / 100 AS item_cash_flows, ordered_qty, canceled_qty,
    orders_cnt, orders_with_canceled_items, year, month, day, city
  FROM items_exact
),
spoiled_orders AS (
  SELECT * REPLACE (CASE WHEN payment_type = '1-URGENT' THEN -user_id ELSE user_id END AS user_id,
    CASE WHEN payment_type = '1-URGENT' THEN store_id + 5 ELSE store_id END AS store_id)
  FROM orders_t
),
spoiled_lines AS (
  SELECT * REPLACE (CASE WHEN item_discount > 0 THEN -order_id
      WHEN item_canceled_quantity = 4 THEN NULL ELSE order_id END AS order_id,
    CASE WHEN item_price > 140 THEN item_id + 50 ELSE item_id END AS item_id,
    coalesce(replaced_by_item_id, CAST(item_quantity AS INT)) AS replaced_by_item_id)
  FROM lines_t
),
spoiled_assignments AS (
  SELECT * REPLACE (CASE WHEN unassigned_at IS NULL THEN -order_id ELSE order_id END AS order_id,
    CASE WHEN unassigned_at IS NULL THEN driver_id ELSE -driver_id END AS driver_id)
  FROM assignments_t
),
shifted_lines AS (
  SELECT * REPLACE (item_quantity - 10 AS item_quantity, item_price - 110 AS item_price,
    item_discount + 95 AS item_discount, item_canceled_quantity - 2 AS item_canceled_quantity)
  FROM lines_t
),
single_lines AS (
  SELECT order_id, item_id, item_price, item_discount, item_quantity,
    CASE WHEN item_replaced_id <> -1 THEN item_replaced_id END AS replaced_by_item_id
  FROM feed WHERE order_id IS NOT NULL AND item_id IS NOT NULL AND item_price IS NOT NULL
    AND item_discount IS NOT NULL
),
unmerged_lines AS (
  SELECT * FROM single_lines UNION ALL
  SELECT * REPLACE (-1 AS replaced_by_item_id) FROM single_lines
  WHERE replaced_by_item_id IS NULL AND item_quantity = 7
),
numbered_lines AS (
  SELECT row_number() OVER (ORDER BY order_id, item_id, item_price,
      item_discount, replaced_by_item_id NULLS LAST) AS order_item_id,
    CAST(order_id AS BIGINT) AS order_id, CAST(item_id AS BIGINT) AS item_id,
    item_quantity, item_price, item_discount, item_canceled_quantity,
    CAST(replaced_by_item_id AS BIGINT) AS replaced_by_item_id FROM lines_t
),
numbered_assignments AS (
  SELECT row_number() OVER (ORDER BY order_id, driver_id, assigned_at,
      unassigned_at NULLS LAST) AS assignment_id, CAST(order_id AS BIGINT) AS order_id,
    CAST(driver_id AS BIGINT) AS driver_id, assigned_at, unassigned_at FROM assignments_t
)
"""

LINE_KEY = "order_id, item_id, item_price, item_discount, replaced_by_item_id"
ASSIGNMENT_KEY = "order_id, driver_id, assigned_at, unassigned_at"
REPLACED_GROUP = "order_id, item_id, item_price, item_discount, coalesce(replaced_by_item_id, -1)"
CELL_KEY = "store_id, item_id, year, month, day, city"


def _key(columns: str) -> str:
    parts = [f"coalesce(CAST({c.strip()} AS VARCHAR), 'NULL')" for c in columns.split(",")]
    return " || ',' || ".join(parts)


def _rows(table: str, kind: str, name: str, key: str, detail: str, source: str, where: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS constraint_name,
      {_key(key)} AS row_key, {detail} AS detail FROM {source} WHERE {where}"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


SOURCES = {
    "users": ("users_t", "user_id", ["user_id", "user_phone"]),
    "stores": ("stores_t", "store_id", ["store_id", "store_address"]),
    "drivers": ("drivers_t", "driver_id", ["driver_id", "driver_phone"]),
    "items": ("items_t", "item_id", ["item_id", "item_title", "item_category"]),
    "orders": (
        "orders_t", "order_id",
        ["order_id", "user_id", "store_id", "address_text", "created_at", "payment_type", "delivery_cost"],
    ),
    "order_items": ("lines_t", LINE_KEY, ["order_id", "item_id", "item_quantity", "item_price"]),
    "delivery_assignments": ("assignments_t", ASSIGNMENT_KEY, ["order_id", "driver_id", "assigned_at"]),
    "orders_datamart": ("orders_mart_t", "order_id", ["order_id", "user_id", "store_id"]),
    "items_datamart": ("items_mart_t", CELL_KEY, ["store_id", "item_id"]),
}

NOT_NULL = _union(
    [
        _rows(table, "not_null", f"{column}_not_null", key, "'NULL'", source, f"{column} IS NULL")
        for table, (source, key, columns) in SOURCES.items()
        for column in columns
    ]
)

LENGTHS = [
    ("users", "users_t", "user_id", "user_phone", 2, 20),
    ("stores", "stores_t", "store_id", "store_address", 16, 255),
    ("drivers", "drivers_t", "driver_id", "driver_phone", 2, 20),
    ("items", "items_t", "item_id", "item_title", 15, 100),
    ("items", "items_t", "item_id", "item_category", 11, 50),
    ("orders", "orders_t", "order_id", "address_text", 18, 255),
    ("orders", "orders_t", "order_id", "payment_type", 2, 20),
    ("orders", "orders_t", "order_id", "order_cancellation_reason", 8, 100),
    ("orders", "orders_t", "order_id", "status", 3, 20),
]

LENGTH = _union(
    [
        _rows(
            table, "length", f"{column}_length", key, f"CAST(length(repeat({column}, {n})) AS VARCHAR)",
            source, f"length(repeat({column}, {n})) > {limit}",
        )
        for table, source, key, column, n, limit in LENGTHS
    ]
)

CHECKS = [
    ("order_items", "shifted_lines", LINE_KEY, "item_quantity_positive", "item_quantity > 0"),
    ("order_items", "shifted_lines", LINE_KEY, "item_price_positive", "item_price > 0"),
    ("order_items", "shifted_lines", LINE_KEY, "item_discount_percent", "item_discount BETWEEN 0 AND 100"),
    (
        "order_items", "shifted_lines", LINE_KEY, "item_canceled_quantity_not_negative",
        "item_canceled_quantity >= 0",
    ),
    (
        "delivery_assignments", "intervals", ASSIGNMENT_KEY, "interval_order",
        "unassigned_at IS NULL OR unassigned_at >= assigned_at",
    ),
]

CHECK = _union(
    [
        _rows(table, "check", name, key, f"'{rule}'", source, f"NOT ({rule})")
        for table, source, key, name, rule in CHECKS
    ]
)


def _repeats(table: str, kind: str, name: str, key: str, source: str, null_too: bool) -> str:
    any_null = " OR ".join(f"{c.strip()} IS NULL" for c in key.split(","))
    having = f"count(*) > 1 OR {any_null}" if null_too else "count(*) > 1"
    return f"""SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS constraint_name,
      {_key(key)} AS row_key, CAST(count(*) AS VARCHAR) AS detail
      FROM {source} GROUP BY {key} HAVING {having}"""


FILLED_LINES = (
    "(SELECT * REPLACE (coalesce(replaced_by_item_id, -1) AS replaced_by_item_id) FROM unmerged_lines)"
)
CANDIDATES = {
    "users": ("user_id", "(SELECT DISTINCT user_id, user_phone FROM feed)"),
    "stores": ("store_id", "(SELECT DISTINCT store_id, store_address FROM feed)"),
    "drivers": ("driver_id", "(SELECT DISTINCT driver_id, driver_phone FROM feed)"),
    "items": ("item_id", "(SELECT DISTINCT item_id, item_title, item_category FROM feed)"),
    "orders": ("order_id", "headers"),
    "orders_datamart": ("order_id", "orders_mart_t"),
    "items_datamart": (CELL_KEY, "items_mart_t"),
}

# Generated keys, halved so that they repeat.
PAIRED = {
    "order_items": ("order_item_id", "(SELECT order_item_id // 2 AS order_item_id FROM numbered_lines)"),
    "delivery_assignments": (
        "assignment_id", "(SELECT assignment_id // 2 AS assignment_id FROM numbered_assignments)",
    ),
}

PRIMARY_KEY = _union(
    [
        _repeats(table, "primary_key", f"{table}_pkey", key, source, null_too=True)
        for table, (key, source) in {**CANDIDATES, **PAIRED}.items()
    ]
)

REFERENCES = [
    ("orders", "spoiled_orders", "order_id", "user_id", "users_t", "user_id"),
    ("orders", "spoiled_orders", "order_id", "store_id", "stores_t", "store_id"),
    ("order_items", "spoiled_lines", LINE_KEY, "order_id", "orders_t", "order_id"),
    ("order_items", "spoiled_lines", LINE_KEY, "item_id", "items_t", "item_id"),
    ("order_items", "spoiled_lines", LINE_KEY, "replaced_by_item_id", "items_t", "item_id"),
    ("delivery_assignments", "spoiled_assignments", ASSIGNMENT_KEY, "order_id", "orders_t", "order_id"),
    ("delivery_assignments", "spoiled_assignments", ASSIGNMENT_KEY, "driver_id", "drivers_t", "driver_id"),
]

FOREIGN_KEY = _union(
    [
        _rows(
            table, "foreign_key", f"{table}_{column}_fkey", key, f"CAST({column} AS VARCHAR)",
            f"{source} AS child",
            f"{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} AS parent WHERE parent.{parent_key} = child.{column})",
        )
        for table, source, key, column, parent, parent_key in REFERENCES
    ]
)


def _zero(table: str, kind: str, name: str, value: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS constraint_name,
      CAST(({value}) AS BIGINT) AS violations"""


def _count_where(source: str, where: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {where}"


def _duplicates(source: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1)"


def _orphans(source: str, column: str, parent: str, parent_key: str) -> str:
    """LEFT JOIN … IS NULL, so a NULL reference counts."""
    return f"""SELECT count(*) FROM {source} child LEFT JOIN {parent} parent
      ON child.{column} = parent.{parent_key} WHERE parent.{parent_key} IS NULL"""


_counted = [
    _zero(table, "not_null", f"{column}_not_null", _count_where(source, f"{column} IS NULL"))
    for table, (source, _, columns) in SOURCES.items()
    for column in columns
    if not table.endswith("datamart")
]
_counted += [
    _zero(table, "length", f"{column}_length", _count_where(source, f"length({column}) > {limit}"))
    for table, source, _, column, _, limit in LENGTHS
]
_counted += [
    _zero(table, "check", name, _count_where("lines_t" if "lines" in source else "assignments_t", f"NOT ({rule})"))
    for table, source, _, name, rule in CHECKS
]
_counted += [
    _zero(table, "primary_key", f"{table}_pkey", _duplicates(SOURCES[table][0], key))
    for table, (key, _) in CANDIDATES.items()
    if not table.endswith("datamart")
]
_counted.append(_zero("order_items", "unique", "order_item_group", _duplicates("lines_t", REPLACED_GROUP)))
_counted += [
    _zero(
        table, "foreign_key", f"{table}_{column}_fkey",
        f"SELECT count(*) FROM {SOURCES[table][0]} child WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} parent WHERE parent.{parent_key} = child.{column})",
    )
    for table, _, _, column, parent, parent_key in REFERENCES
]


LENGTHENED = {
    table: f"(SELECT * REPLACE ({', '.join(f'repeat({c}, {n}) AS {c}' for t, _, _, c, n, _ in LENGTHS if t == table)}) FROM {source})"
    for table, source in {t: s for t, s, *_ in LENGTHS}.items()
}
_observed = [
    _zero(table, "not_null", f"{column}_not_null", _count_where(LENGTHENED[table], f"{column} IS NULL"))
    for table, (_, _, columns) in SOURCES.items()
    for column in columns
    if table in LENGTHENED
]
_observed += [
    _zero(table, "length", f"{column}_length", _count_where(LENGTHENED[table], f"length({column}) > {limit}"))
    for table, _, _, column, _, limit in LENGTHS
]
_observed += [_zero(table, "rows", "rows", f"SELECT count(*) FROM {source}") for table, source in LENGTHENED.items()]
_observed += [
    _zero("order_items", "not_null", f"{column}_not_null", _count_where("shifted_lines", f"{column} IS NULL"))
    for column in SOURCES["order_items"][2]
]
_observed.append(_zero("order_items", "not_null", "order_item_id_not_null", "0"))
_observed += [
    _zero(table, "check", name, _count_where(source, f"NOT ({rule})"))
    for table, source, _, name, rule in CHECKS
    if table == "order_items"
]
_observed.append(_zero("order_items", "rows", "rows", "SELECT count(*) FROM shifted_lines"))


def _check(name: str, normalised: str, spoiled: str) -> str:
    return _union(
        [
            f"SELECT '{name}' AS check_name, '{dataset}' AS dataset, CAST(({value}) AS BIGINT) AS value"
            for dataset, value in (("normalised", normalised), ("spoiled", spoiled))
        ]
    )


NON_DIGIT = "regexp_matches({}, '[^0-9]')"
LOST_REPLACEMENT = """SELECT count(*) FROM {} l LEFT JOIN items_t i ON l.replaced_by_item_id = i.item_id
  WHERE l.replaced_by_item_id IS NOT NULL AND i.item_id IS NULL"""
INVERTED = "unassigned_at IS NOT NULL AND unassigned_at < assigned_at"

CHECK_VALUES = {
    "orphan_order_items": [
        _orphans(source, "order_id", "orders_t", "order_id") for source in ("lines_t", "spoiled_lines")
    ],
    "orders_without_users": [
        _orphans(source, "user_id", "users_t", "user_id") for source in ("orders_t", "spoiled_orders")
    ],
    "orders_without_stores": [
        _orphans(source, "store_id", "stores_t", "store_id") for source in ("orders_t", "spoiled_orders")
    ],
    "invalid_replaced_items": [LOST_REPLACEMENT.format(source) for source in ("lines_t", "spoiled_lines")],
    "duplicate_order_item_groups": [
        _duplicates(source, REPLACED_GROUP) for source in ("lines_t", "unmerged_lines")
    ],
    "invalid_assignment_dates": [
        _count_where(source, INVERTED) for source in ("assignments_t", "intervals")
    ],
    "users_non_digit_phones": [
        _count_where(source, NON_DIGIT.format("user_phone")) for source in ("users_t", "raw_users")
    ],
    "drivers_non_digit_phones": [
        _count_where(source, NON_DIGIT.format("driver_phone")) for source in ("drivers_t", "raw_drivers")
    ],
}

BASE_TABLES = {table: source for table, (source, _, _) in SOURCES.items() if not table.endswith("datamart")}

QUALITY_REPORT = _union(
    [
        f"SELECT '{table}_count' AS check_name, 'not_empty' AS kind, count(*) AS value, "
        f"count(*) > 0 AS passed FROM {source}"
        for table, source in BASE_TABLES.items()
    ]
    + [
        f"SELECT '{name}' AS check_name, 'no_violation' AS kind, CAST(({values[0]}) AS BIGINT) AS value, "
        f"({values[0]}) = 0 AS passed"
        for name, values in CHECK_VALUES.items()
    ]
)


def _hundredths(exact: str, divisor: int) -> str:
    """Exact integer to DECIMAL(14,2), halves away from zero."""
    half = divisor // 200
    step = divisor // 100
    whole = f"(sign({exact}) * ((abs({exact}) + {half}) // {step}))" if step > 1 else exact
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2))"


def _wide(*ids: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in ids)


SELECTS: dict[str, str] = {
    "raw_feed_scan": "SELECT * EXCLUDE (row_no, file_no), CAST(file_no AS BIGINT) AS file_no FROM feed",
    "scan_table": f"SELECT * REPLACE ({_wide('order_id', 'user_id', 'store_id')}) FROM orders_t",
    "normalize_phone": f"""SELECT order_id, user_id, {_phone("user_phone")} AS user_phone,
      {_phone("driver_phone")} AS driver_phone FROM feed""",
    "nan_to_null": """SELECT l_orderkey, l_linenumber,
      CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS price FROM lineitem""",
    "replaced_id_sentinel": """SELECT order_id, item_id, coalesce(item_replaced_id, -1) AS filled_id,
      CASE WHEN item_replaced_id <> -1 THEN item_replaced_id END AS replaced_by_item_id FROM feed""",
    "order_lines_null_key_drop": """SELECT order_id, item_id, item_price, item_discount, item_quantity
      FROM feed WHERE order_id IS NOT NULL AND item_id IS NOT NULL AND item_price IS NOT NULL
      AND item_discount IS NOT NULL""",
    "order_lines_file": "SELECT * REPLACE (CAST(file_no AS BIGINT) AS file_no) FROM file_lines",
    "driver_history": "SELECT * REPLACE (CAST(file_no AS BIGINT) AS file_no) FROM history",
    "dim_users": "SELECT * FROM users_t",
    "dim_stores": "SELECT * FROM stores_t",
    "dim_drivers": "SELECT * FROM drivers_t",
    "dim_items": "SELECT * FROM items_t",
    "orders_normalized": "SELECT * FROM orders_t",
    "order_items": "SELECT * FROM lines_t",
    "delivery_assignments": "SELECT * FROM assignments_t",
    "order_items_keyed": "SELECT * FROM numbered_lines",
    "assignments_keyed": "SELECT * FROM numbered_assignments",
    "order_status": "SELECT order_id, status FROM orders_t",
    "open_assignments": "SELECT * FROM assignments_t WHERE unassigned_at IS NULL",
    "current_driver": "SELECT * FROM current_t",
    "row_counts": _union(
        [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in BASE_TABLES.items()]
    ),
    "orders_left_items": """SELECT o.order_id, user_id, store_id, status, order_discount, item_id,
      item_price, item_discount, replaced_by_item_id, item_quantity, item_canceled_quantity
      FROM orders_t o LEFT JOIN lines_t l ON o.order_id = l.order_id""",
    "orders_current_driver": """SELECT o.order_id, status, driver_id
      FROM orders_t o LEFT JOIN current_t d ON o.order_id = d.order_id""",
    "items_left_join": """SELECT l.*, item_title, item_category
      FROM lines_t l LEFT JOIN items_t i ON l.item_id = i.item_id""",
    "store_join_noop": "SELECT order_id, store_id, cash_flows, revenue FROM orders_mart_t",
    "order_cash_flows": "SELECT order_id, cash_flows FROM orders_mart_t",
    "order_revenue": "SELECT order_id, status, revenue FROM orders_mart_t",
    "cancel_flags": """SELECT order_id, status, is_cancel_error, is_cancel_after_delivery
      FROM orders_mart_t""",
    "address_city": """SELECT order_id, address_text, split_part(address_text, ',', 1) AS city
      FROM orders_t""",
    "order_date_parts": "SELECT order_id, year, month, day FROM orders_mart_t",
    "orders_mart": "SELECT * FROM orders_mart_t",
    "items_mart": "SELECT * FROM items_mart_t",
    "conform_orders_mart": f"""SELECT m.* REPLACE (
      {_wide("order_id", "user_id", "store_id", "driver_id")},
      {_hundredths("cash_exact", 10000)} AS cash_flows, {_hundredths("revenue_exact", 10000)} AS revenue)
      FROM orders_mart_t m JOIN (SELECT order_id, cash_exact, revenue_exact FROM orders_exact) e
      USING (order_id)""",
    "conform_items_mart": f"""SELECT {_wide("store_id", "item_id")}, item_category, item_title,
      {_hundredths("cash_exact", 100)} AS item_cash_flows, CAST(ordered_qty AS INT) AS ordered_qty,
      CAST(canceled_qty AS INT) AS canceled_qty, CAST(orders_cnt AS INT) AS orders_cnt,
      CAST(orders_with_canceled_items AS INT) AS orders_with_canceled_items, year, month, day, city
      FROM items_exact""",
    "item_orders_cnt": """SELECT make_date(year, month, day) AS created_on, city, store_id, item_id,
      orders_cnt FROM items_mart_t""",
    "item_canceled_orders_cnt": """SELECT make_date(year, month, day) AS created_on, city, store_id,
      item_id, orders_with_canceled_items FROM items_mart_t""",
    "not_null_violations": NOT_NULL,
    "pk_violations": PRIMARY_KEY,
    "fk_violations": FOREIGN_KEY,
    "check_violations": CHECK,
    "length_violations": LENGTH,
    "unique_group_violations": _repeats(
        "order_items", "unique", "order_item_group", LINE_KEY, FILLED_LINES, null_too=False
    ),
    "constraint_counts": _union(_counted),
    "observed_rule_counts": _union(_observed),
    "laid_out_orders_mart": f"""SELECT * REPLACE ({_wide("order_id", "user_id", "store_id", "driver_id")})
      FROM orders_mart_t""",
    "laid_out_items_mart": f"SELECT * REPLACE ({_wide('store_id', 'item_id')}) FROM items_mart_t",
    **{name: _check(name, *values) for name, values in CHECK_VALUES.items()},
    "quality_report": QUALITY_REPORT,
}

ORACLE_SQL = {name: f"{BASE}\n{select}" for name, select in SELECTS.items()}
