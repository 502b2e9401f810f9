from pyspark.sql import functions as F

from delivery_marts.functions import (
    address_city,
    cancel_after_delivery_flag,
    cancel_error_flag,
    date_parts,
    has_non_digit,
    nan_to_null,
    normalize_phone,
    order_status,
    unfill_replaced_id,
)
from tests.conftest import at

MOMENTS = ("paid_at", "delivery_started_at", "delivered_at", "canceled_at")
TIMES = ", ".join(f"{name} timestamp_ntz" for name in MOMENTS)


def apply(spark, function, inputs, kind="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"n int, v {kind}")
    return [r.out for r in df.select("n", function(F.col("v")).alias("out")).orderBy("n").collect()]


def test_phones_keep_digits_and_lose_the_trunk_prefix(spark):
    cases = {
        None: None,
        "": None,
        "n/a": None,
        "8 (900) 123-45-67": "79001234567",
        "+7 900 123-45-67": "79001234567",
        "9001234567": "9001234567",
        "89001": "89001",
        "890012345678": "890012345678",
        "88888888888": "78888888888",
        "8900123456": "8900123456",
    }
    assert apply(spark, normalize_phone, list(cases)) == list(cases.values())


def test_digits_of_other_scripts_are_stripped(spark):
    assert apply(spark, normalize_phone, ["٩12", "٩"]) == ["12", None]


def test_non_digit_predicate_ignores_null_and_empty(spark):
    assert apply(spark, has_non_digit, [None, "", "123", "+123", "12 3"]) == [None, False, False, True, True]


def test_nan_becomes_null_and_sentinel_unfills(spark):
    assert apply(spark, nan_to_null, [float("nan"), 1.5, None], "double") == [None, 1.5, None]
    assert apply(spark, unfill_replaced_id, [-1, 7, None, 0], "int") == [None, 7, None, 0]


def test_city_is_the_untrimmed_text_before_the_first_comma(spark):
    cases = {"Москва, ул. 1": "Москва", " Москва,x": " Москва", "Москва": "Москва", "": "", None: None, ",x": ""}
    assert apply(spark, address_city, list(cases)) == list(cases.values())


def test_status_is_the_latest_stage_with_cancellation_first(spark):
    t = at("10:00")
    rows = [
        (None, None, None, None, "created"),
        (t, None, None, None, "paid"),
        (t, t, None, None, "in_delivery"),
        (t, t, t, None, "delivered"),
        (t, t, t, t, "canceled"),
        (None, None, None, t, "canceled"),
    ]
    df = spark.createDataFrame(rows, f"{TIMES}, expected string")
    assert df.where(order_status() != F.col("expected")).count() == 0
    assert df.where(order_status().isNull()).count() == 0


def test_cancellation_flags(spark):
    rows = [
        ("canceled", "Ошибка приложения", None, at("10:00"), 1, 0),
        ("canceled", "Проблемы с оплатой", None, at("10:00"), 1, 0),
        ("canceled", None, None, at("10:00"), 0, 0),
        ("canceled", "other", at("10:00"), at("10:00"), 0, 0),
        ("canceled", "other", at("10:00"), at("10:01"), 0, 1),
        ("delivered", "Проблемы с оплатой", at("10:00"), None, 0, 0),
        (None, "Проблемы с оплатой", None, None, 0, 0),
    ]
    schema = "status string, reason string, delivered_at timestamp_ntz, canceled_at timestamp_ntz, error int, after int"
    df = spark.createDataFrame(rows, schema)
    got = df.select(
        cancel_error_flag(F.col("status"), F.col("reason")).alias("a"),
        cancel_after_delivery_flag(F.col("delivered_at"), F.col("canceled_at")).alias("b"),
        "error",
        "after",
    ).collect()
    assert all((r.a, r.b) == (r.error, r.after) for r in got)


def test_date_parts_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-12-31 23:59:59' AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert tuple(df.select(*date_parts(F.col("t")).values()).first()) == (2024, 12, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
