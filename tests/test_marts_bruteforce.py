"""Marts on small edge-case fixtures against brute-force Python that joins
first and groups after (the plain reading of the mart definitions)."""

import datetime as dt
from decimal import Decimal

from strata.plans.marts import customer_rfm, daily_sales, seller_performance

D = dt.datetime
ORDERS = [  # order_id, customer_id, purchase ts, purchase date
    ("o1", "c1", D(2001, 1, 1, 10), dt.date(2001, 1, 1)),
    ("o2", "c1", D(2001, 1, 3, 9), dt.date(2001, 1, 3)),
    ("o3", "c2", D(2001, 1, 3, 12), dt.date(2001, 1, 3)),
    ("o4", "c3", D(2001, 2, 1, 0), dt.date(2001, 2, 1)),       # no items
    ("o5", "c9", D(2001, 2, 2, 0), dt.date(2001, 2, 2)),       # customer unknown
]
HOT = [("o1", str(i), "s1", 1.25, 0.5) for i in range(1, 41)]  # one order holds most rows
ITEMS = HOT + [  # order_id, item_id, seller_id, price, freight
    ("o1", "41", "s2", 10.0, None),
    ("o2", "1", "s2", None, 1.0),
    ("o2", "2", "s1", 3.33, 0.01),
    ("o3", "1", "s3", 7.5, 2.0),                                  # seller unknown
    ("o9", "1", "s2", 5.0, 1.0),                                  # order unknown
    ("o3", "2", None, 2.0, 1.0),                                  # null seller key
    ("o2", "3", None, 4.0, None),
    *[("o1", i, "s2", 0.75, 0.25) for i in ("63", "64", "65", "200", "01", "+1", "x7", "99999999999999999999")],
    *[("o2", i, "s2", 0.5, 0.5) for i in ("64", "01", "x7", "130")],
    ("o3", "64", "s1", 1.0, 1.0),
]
SELLERS = [("s1", "city1", "st1"), ("s2", "city2", "st2")]
REVIEWS = [  # review_id, order_id, score, answer ts
    ("r1", "o1", 5, D(2001, 1, 5)), ("r2", "o1", 1, D(2001, 1, 6)),   # latest wins -> 1
    ("r3", "o2", 4, D(2001, 1, 9)),
]
CUSTOMERS = [("c1", "u1", "x", "X"), ("c2", "u2", "y", "Y"), ("c3", "u3", "z", "Z")]
AS_OF = dt.date(2002, 1, 1)


def _dfs(spark):
    orders = spark.createDataFrame(
        ORDERS, "order_id string, customer_id string, order_purchase_timestamp timestamp, "
                "order_purchase_date date")
    items = spark.createDataFrame(
        ITEMS, "order_id string, order_item_id string, seller_id string, price double, freight_value double")
    sellers = spark.createDataFrame(SELLERS, "seller_id string, seller_city string, seller_state string")
    reviews = spark.createDataFrame(
        REVIEWS, "review_id string, order_id string, review_score int, review_answer_timestamp timestamp")
    customers = spark.createDataFrame(
        CUSTOMERS, "customer_id string, customer_unique_id string, customer_city string, customer_state string")
    return orders, items, sellers, reviews, customers


def _money(vals):
    vals = [Decimal(repr(v)) for v in vals if v is not None]
    return float(sum(vals)) if vals else None


def _avg(vals):
    vals = [Decimal(repr(v)) for v in vals if v is not None]
    return float(sum(vals)) / len(vals) if vals else None


def brute_seller():
    o = {r[0]: r for r in ORDERS}
    s = {r[0]: r for r in SELLERS}
    latest = {}
    for r in REVIEWS:
        if r[1] not in latest or (r[3], r[0]) > (latest[r[1]][3], latest[r[1]][0]):
            latest[r[1]] = r
    groups = {}
    for oid, iid, sid, price, freight in ITEMS:          # items LEFT orders LEFT sellers LEFT reviews
        srow = s.get(sid)
        key = (sid, srow[1] if srow else None, srow[2] if srow else None)
        orow = o.get(oid)
        rev = latest.get(oid)
        groups.setdefault(key, []).append((oid, iid, price, freight, rev[2] if rev else None,
                                           orow[2].date() if orow else None))
    out = {}
    for key, rows in groups.items():
        scores = [r[4] for r in rows if r[4] is not None]
        dates = [r[5] for r in rows if r[5] is not None]
        out[key[0]] = (key[1], key[2], len({r[0] for r in rows}), len({r[1] for r in rows}),
                       _money([r[2] for r in rows]), _avg([r[2] for r in rows]), _avg([r[3] for r in rows]),
                       sum(scores) / len(scores) if scores else None,
                       min(dates) if dates else None, max(dates) if dates else None)
    return out


def test_seller_performance_matches_brute_force(spark, cfg):
    orders, items, sellers, reviews, _ = _dfs(spark)
    got = {r.seller_id: (r.seller_city, r.seller_state, r.total_orders, r.total_order_items, r.total_revenue,
                         r.avg_item_price, r.avg_freight_value, r.avg_review_score, r.min_order_date,
                         r.max_order_date)
           for r in seller_performance(orders, items, sellers, reviews, cfg).collect()}
    assert got == brute_seller()


def test_customer_rfm_matches_brute_force(spark, cfg):
    orders, items, _, _, customers = _dfs(spark)
    totals = {}
    for oid, _iid, _sid, price, _f in ITEMS:
        totals.setdefault(oid, []).append(price)
    c = {r[0]: r for r in CUSTOMERS}
    groups = {}
    for oid, cid, _ts, d in ORDERS:                       # orders LEFT totals LEFT customers
        value = [Decimal(repr(p)) for p in totals.get(oid, []) if p is not None]
        value = sum(value) if oid in totals and value else None
        groups.setdefault(cid, []).append((oid, value, d))
    want = {}
    for cid, rows in groups.items():
        vals = [r[1] for r in rows if r[1] is not None]
        crow = c.get(cid, (cid, None, None, None))
        last = max(r[2] for r in rows)
        want[cid] = (crow[1], crow[2], crow[3], len(rows), float(sum(vals)) if vals else None,
                     float(sum(vals)) / len(vals) if vals else None, min(r[2] for r in rows), last,
                     (AS_OF - last).days)
    got = {r.customer_id: (r.customer_unique_id, r.customer_city, r.customer_state, r.frequency_orders,
                           r.monetary_value, r.avg_order_value, r.first_order_date, r.last_order_date,
                           r.recency_days)
           for r in customer_rfm(orders, items, customers, cfg).collect()}
    assert got == want


def test_daily_sales_matches_brute_force(spark, cfg):
    orders, items, *_ = _dfs(spark)
    o = {r[0]: r for r in ORDERS}
    groups = {}
    for oid, iid, _sid, price, _f in ITEMS:               # orders INNER items
        if oid in o:
            groups.setdefault(o[oid][3], []).append((oid, o[oid][1], iid, price))
    want = {d: (len({r[0] for r in rows}), len({r[1] for r in rows}), len({r[2] for r in rows}),
                _money([r[3] for r in rows]), _avg([r[3] for r in rows]))
            for d, rows in groups.items()}
    got = {r.order_date: (r.total_orders, r.total_customers, r.total_items, r.total_revenue, r.avg_item_price)
           for r in daily_sales(orders, items, cfg).collect()}
    assert got == want
