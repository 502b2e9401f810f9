import pytest

from delivery_marts.operators.constraints import row_violations, violation_counts, violations
from delivery_marts.operators.quality import QualityError, assert_quality, orphan_check, quality_report
from delivery_marts.schemas import TABLES
from delivery_marts.sinks.conform import apply_defaults
from tests.conftest import at, clean_tables, make_table, values

CHECK_NAMES = {
    "users_count", "stores_count", "drivers_count", "items_count", "orders_count", "order_items_count",
    "delivery_assignments_count", "orphan_order_items", "orders_without_users", "orders_without_stores",
    "invalid_replaced_items", "duplicate_order_item_groups", "invalid_assignment_dates",
    "users_non_digit_phones", "drivers_non_digit_phones",
}


def test_clean_tables_pass_everything(spark):
    t = clean_tables(spark)
    results = assert_quality(quality_report(t))
    assert set(results) == CHECK_NAMES
    assert violations(t, TABLES).count() == 0
    assert violation_counts(t, TABLES).where("violations <> 0").count() == 0


BAD_QUALITY = {
    "users_count": {"users": []},
    "stores_count": {"stores": []},
    "drivers_count": {"drivers": []},
    "items_count": {"items": []},
    "orders_count": {"orders": []},
    "order_items_count": {"order_items": []},
    "delivery_assignments_count": {"delivery_assignments": []},
    "orphan_order_items": {"order_items": [{}, {"order_id": 5}]},
    "orders_without_users": {"orders": [{}, {"order_id": 2, "user_id": 5}]},
    "orders_without_stores": {"orders": [{}, {"order_id": 2, "store_id": 5}]},
    "invalid_replaced_items": {"order_items": [{}, {"replaced_by_item_id": 5}]},
    "duplicate_order_item_groups": {"order_items": [{}, {}, {}]},
    "invalid_assignment_dates": {"delivery_assignments": [{}, {"unassigned_at": at("10:29")}]},
    "users_non_digit_phones": {"users": [{"user_id": 1, "user_phone": "+79"}]},
    "drivers_non_digit_phones": {"drivers": [{"driver_id": 1, "driver_phone": "7 9"}]},
}


@pytest.mark.parametrize("check", sorted(BAD_QUALITY))
def test_each_check_fails_on_its_own_fault(spark, check):
    report = quality_report(clean_tables(spark, **BAD_QUALITY[check])).collect()
    failed = {r.check_name for r in report if not r.passed}
    # an empty parent table also orphans its children
    allowed = {
        "users_count": {"orders_without_users"},
        "stores_count": {"orders_without_stores"},
        "orders_count": {"orphan_order_items"},
    }.get(check, set())
    assert failed - allowed == {check}
    assert len(report) == len(CHECK_NAMES)


def test_null_references_are_orphans_but_not_foreign_key_violations(spark):
    t = clean_tables(spark, order_items=[{}, {"order_item_id": 2, "order_id": None}])
    assert orphan_check("orphan_order_items", t["order_items"], t["orders"]).first().value == 1
    counts = violation_counts(t, {"order_items": TABLES["order_items"]})
    broken = values(counts.where("violations > 0"), "kind", "constraint_name")
    assert broken == [("not_null", "order_id_not_null")]


def test_verdict_names_what_failed(spark):
    t = clean_tables(spark, drivers=[], order_items=[{}, {"replaced_by_item_id": 5}])
    with pytest.raises(QualityError, match="drivers_count.*invalid_replaced_items"):
        assert_quality(quality_report(t))


BAD_ROWS = {
    ("not_null", "user_phone_not_null"): {"users": [{"user_id": 1, "user_phone": None}]},
    ("length", "user_phone_length"): {"users": [{"user_id": 1, "user_phone": "7" * 21}]},
    ("length", "address_text_length"): {"orders": [{"address_text": "ж" * 256}]},
    ("primary_key", "users_pkey"): {"users": [{}, {}]},
    ("primary_key", "order_items_pkey"): {"order_items": [{}, {"item_price": 5}]},
    ("foreign_key", "orders_user_id_fkey"): {"orders": [{"user_id": 5}]},
    ("foreign_key", "orders_store_id_fkey"): {"orders": [{"store_id": 5}]},
    ("foreign_key", "order_items_order_id_fkey"): {"order_items": [{"order_id": 5}]},
    ("foreign_key", "order_items_item_id_fkey"): {"order_items": [{"item_id": 5}]},
    ("foreign_key", "order_items_replaced_by_item_id_fkey"): {"order_items": [{"replaced_by_item_id": 5}]},
    ("foreign_key", "delivery_assignments_order_id_fkey"): {"delivery_assignments": [{"order_id": 5}]},
    ("foreign_key", "delivery_assignments_driver_id_fkey"): {"delivery_assignments": [{"driver_id": 5}]},
    ("check", "item_quantity_positive"): {"order_items": [{"item_quantity": 0}]},
    ("check", "item_price_positive"): {"order_items": [{"item_price": 0}]},
    ("check", "item_discount_percent"): {"order_items": [{"item_discount": 101}]},
    ("check", "item_canceled_quantity_not_negative"): {"order_items": [{"item_canceled_quantity": -1}]},
    ("check", "interval_order"): {"delivery_assignments": [{"unassigned_at": at("10:29")}]},
    ("unique", "order_item_group"): {"order_items": [{}, {"order_item_id": 2, "item_quantity": 5}]},
}


def test_no_replacement_and_its_id_are_one_key(spark):
    rows = [{}, {"order_item_id": 2, "replaced_by_item_id": -1}, {"order_item_id": 3, "replaced_by_item_id": 1}]
    t = clean_tables(spark, order_items=rows)
    report = {r.check_name: r.value for r in quality_report(t).collect()}
    assert report["duplicate_order_item_groups"] == 1
    unique = violations(t, {"order_items": TABLES["order_items"]}).where("kind = 'unique'")
    assert values(unique, "row_key", "detail") == [("1,1,100,0,-1", "2")]


@pytest.mark.parametrize("kind,name", sorted(BAD_ROWS))
def test_each_constraint_fails_on_its_own_fault(spark, kind, name):
    t = clean_tables(spark, **BAD_ROWS[kind, name])
    specs = {table: TABLES[table] for table in BAD_ROWS[kind, name]}
    assert values(violations(t, specs), "kind", "constraint_name") == [(kind, name)]
    counts = violation_counts(t, specs).where("violations > 0")
    counted = values(counts, "kind", "constraint_name", "violations")
    assert counted == [(kind, name, 1)]


def test_null_passes_a_check_and_equal_ends_are_in_order(spark):
    t = clean_tables(
        spark,
        order_items=[{"item_discount": None, "item_canceled_quantity": None}],
        delivery_assignments=[{"unassigned_at": at("10:30")}, {"assignment_id": 2, "unassigned_at": None}],
    )
    assert violations(t, TABLES).count() == 0


def test_null_primary_key_is_a_violation(spark):
    t = clean_tables(spark, users=[{"user_id": 1}, {"user_id": None}])
    kinds = {r.kind for r in violations(t, {"users": TABLES["users"]}).collect()}
    assert kinds == {"primary_key", "not_null"}


def test_violations_name_row_and_detail(spark):
    t = clean_tables(spark, order_items=[{"item_quantity": 0, "replaced_by_item_id": 5}])
    got = values(violations(t, {"order_items": TABLES["order_items"]}), "table_name", "constraint_name", "row_key", "detail")
    key = "1,1,100,0,5"
    assert got == [
        ("order_items", "item_quantity_positive", key, "item_quantity > 0"),
        ("order_items", "order_items_replaced_by_item_id_fkey", key, "5"),
    ]


def test_kinds_without_rules_give_no_rows(spark):
    assert row_violations(clean_tables(spark)["users"], TABLES["users"], "check").count() == 0


def test_defaults_are_opt_in(spark):
    filled = apply_defaults(make_table(spark, "order_items", {"order_item_id": 1}), TABLES["order_items"])
    got = values(filled, "item_discount", "item_canceled_quantity", "replaced_by_item_id")
    assert got == [(0, 0, None)]
