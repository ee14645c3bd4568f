"""Dirty-row behaviour of the process and curate layers (literal edge rows)."""

import math

from strata.plans.curate import CURATE
from strata.plans.process import PROCESS
from strata.specs import ENTITIES


def _raw(spark, name, rows):
    return spark.createDataFrame(rows, ENTITIES[name].raw_schema)


def test_process_orders_drops_bad_and_keeps_a_valid_row_per_key(spark, cfg):
    rows = [
        ("1", "c1", "ok", "not-a-date", None, None, None, None),
        ("1", "c1", "ok", "2001-02-03 04:05:06", None, None, None, None),
        ("2", None, "ok", "2001-02-03 04:05:06", None, None, None, None),
        (None, "c3", "ok", "2001-02-03 04:05:06", None, None, None, None),
    ]
    out = PROCESS["orders"](_raw(spark, "orders", rows), cfg).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.order_id, r.order_purchase_year, r.order_purchase_month) == ("1", 2001, 2)
    assert r.record_source == "olist"


def test_process_order_items_money_rules(spark, cfg):
    rows = [
        ("o", "1", "p", "s", "2001-01-01 00:00:00", "NaN", "1.0"),      # NaN passes >= 0
        ("o", "2", "p", "s", "2001-01-01 00:00:00", "-0.5", "1.0"),     # negative dropped
        ("o", "3", "p", "s", "2001-01-01 00:00:00", None, "1.0"),       # null dropped
        ("o", "x", "p", "s", "2001-01-01 00:00:00", "1.0", "1.0"),      # bad item id dropped
        ("o", "4", None, "s", "2001-01-01 00:00:00", "1.0", "1.0"),     # null product dropped
    ]
    out = PROCESS["order_items"](_raw(spark, "order_items", rows), cfg).collect()
    assert [r.order_item_id for r in out] == [1]
    assert math.isnan(out[0].price)


def test_process_reviews_score_range(spark, cfg):
    rows = [(str(i), "o", s, "t", "m", None, None)
            for i, s in enumerate(["0", "1", "5", "6", "x", None, " 3 "])]
    out = PROCESS["reviews"](_raw(spark, "reviews", rows), cfg).collect()
    assert sorted(r.review_score for r in out) == [1, 3, 5]


def test_process_category_translation_keeps_one_null_key(spark, cfg):
    rows = [(None, "a"), (None, "b"), ("x", "y")]
    out = PROCESS["category_translation"](_raw(spark, "category_translation", rows), cfg).collect()
    assert sorted((r[0] or "", r[1]) for r in out) == [("", "a"), ("x", "y")]
    assert "record_source" not in out[0].asDict()


def test_curate_trims_and_keeps_blank_ids(spark, cfg):
    rows = [("\tc1", "u", "z", " city ", "st"), ("   ", "u", "z", "c", "st"), ("c2 ", "u", "z", "c", "st"),
            ("c2", "v", "z", "c", "st")]
    processed = PROCESS["customers"](_raw(spark, "customers", rows), cfg)
    out = {r.customer_id: r for r in CURATE["customers"](processed, cfg).collect()}
    assert set(out) == {"\tc1", "", "c2"}          # tab kept, blank id kept as ''
    assert out["\tc1"].customer_city == "city"
    assert out["c2"].customer_unique_id == "u"     # 'c2 ' and 'c2' collapse after trim
    assert out["c2"].record_source == "processed_layer.customers"


def test_curate_orders_rejects_blank_status(spark, cfg):
    rows = [("1", "c", "  ", "2001-01-01 00:00:00", None, None, None, None),
            ("2", "c", "ok", "2001-01-01 00:00:00", None, None, None, None)]
    processed = PROCESS["orders"](_raw(spark, "orders", rows), cfg)
    assert [r.order_id for r in CURATE["orders"](processed, cfg).collect()] == ["2"]


def test_curate_order_items_rounds_and_stringifies(spark, cfg):
    rows = [("o", "1", "p", "s", "2001-01-01 00:00:00", "10.005", "0.1249")]
    processed = PROCESS["order_items"](_raw(spark, "order_items", rows), cfg)
    out = CURATE["order_items"](processed, cfg)
    assert out.schema["order_item_id"].dataType.simpleString() == "string"
    r = out.first()
    assert (r.price, r.freight_value) == (10.01, 0.12)


def test_curate_is_idempotent_on_curated_data(spark, cfg):
    from strata.catalog import curated
    from tests.conftest import SF_SMALL
    for name in ("customers", "order_items", "sellers"):
        once = curated(spark, SF_SMALL, name)
        twice = CURATE[name](once, cfg)
        assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_layer_column_order_matches_the_oracle_order(spark, cfg):
    """The dedupe's total order is 'every business column in schema order';
    the oracle SQL spells the same list, so the schemas must agree."""
    from strata.catalog import curated, processed
    from strata.oracle import CURATED_COLS, PROCESSED_COLS
    from strata.specs import LINEAGE_COLUMNS
    from tests.conftest import SF_SMALL
    for name in ENTITIES:
        p = [c for c in processed(spark, SF_SMALL, name).columns if c not in LINEAGE_COLUMNS]
        c = [c for c in curated(spark, SF_SMALL, name).columns if c not in LINEAGE_COLUMNS]
        assert p == list(PROCESSED_COLS[name]), name
        assert c == list(CURATED_COLS[name]), name
