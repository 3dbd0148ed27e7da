"""The golden micro-fixture: 33 hand-made input rows and the expected table."""

from __future__ import annotations

import datetime as dt

from featuremart.sources.tables import Sources

D = dt.datetime
RUN = D(2025, 6, 10)

CUSTOMERS = [(1, D(2025, 1, 1)), (1, D(2025, 1, 1)), (2, D(2025, 1, 1)), (3, D(2025, 6, 20)), (None, None)]

SESSIONS = [
    (10, 1, D(2025, 6, 5, 10)),
    (10, 1, D(2025, 6, 5, 10)),
    (11, 1, D(2025, 5, 20, 9)),
    (12, 1, D(2025, 4, 1, 9)),
    (13, 2, D(2025, 6, 3)),
    (14, 2, D(2025, 6, 10)),
    (15, 99, D(2025, 6, 8)),
    (None, 2, D(2025, 6, 9, 8)),
]

EVENTS = [
    (100, 10, D(2025, 6, 5, 10), "page_view", "A"),
    (100, 10, D(2025, 6, 5, 10), "page_view", "A"),
    (101, 10, D(2025, 6, 5, 10, 10), "add_to_cart", "A"),
    (102, 10, D(2025, 6, 5, 10, 20, 0, 500000), "purchase", "A"),
    (103, 10, D(2025, 6, 5, 10, 30), "page_view", None),
    (104, 11, D(2025, 5, 20, 9), "page_view", "B"),
    (105, 11, D(2025, 5, 20, 9, 1), "search", "C"),
    (106, 13, D(2025, 6, 3), "page_view", "A"),
    (107, 13, D(2025, 6, 10), "purchase", "A"),
    (108, 14, D(2025, 6, 9, 23, 59), "page_view", "D"),
    (109, None, D(2025, 6, 9, 8), "page_view", "E"),
    (110, 12, D(2025, 6, 4, 12), "add_to_cart", "F"),
    (111, 15, D(2025, 6, 8), "purchase", "A"),
]

ORDERS = [
    (1000, 1, D(2025, 6, 9, 23), "10.50"),
    (1000, 1, D(2025, 6, 9, 23), "10.50"),
    (1001, 1, D(2025, 5, 11), "20"),
    (1002, 1, D(2025, 5, 10, 23, 59, 59), "99"),
    (1003, 1, D(2025, 6, 1), "bad"),
    (1004, 2, D(2025, 3, 1), "5"),
    (1005, 2, D(2025, 6, 10), "7"),
]

EXPECTED = {
    "page_view_7": {1: 1, 2: 2, 3: 0, None: 0},
    "add_to_cart_7": {1: 2, 2: 0, 3: 0, None: 0},
    "purchase_7": {1: 1, 2: 0, 3: 0, None: 0},
    "unique_products_7": {1: 2, 2: 2, 3: 0, None: 0},
    "page_view_30": {1: 2, 2: 2, 3: 0, None: 0},
    "add_to_cart_30": {1: 2, 2: 0, 3: 0, None: 0},
    "purchase_30": {1: 1, 2: 0, 3: 0, None: 0},
    "unique_products_30": {1: 4, 2: 2, 3: 0, None: 0},
    "avg_session_length_30": {1: 630.25, 2: 0.0, 3: 0.0, None: 0.0},
    "sessions_7": {1: 1, 2: 2, 3: 0, None: 0},
    "sessions_30": {1: 2, 2: 2, 3: 0, None: 0},
    "days_since_last_purchase": {1: 0, 2: 101, 3: -1, None: -1},
    "orders_30": {1: 3, 2: 0, 3: 0, None: 0},
    "sum_total_usd_30": {1: 30.5, 2: 0.0, 3: 0.0, None: 0.0},
    "avg_total_usd_30": {1: 30.5 / 3, 2: 0.0, 3: 0.0, None: 0.0},
    "conversion_page_to_cart_7": {1: 2.0, 2: None, 3: None, None: None},
    "conversion_page_to_cart_30": {1: 1.0, 2: None, 3: None, None: None},
    "conversion_cart_to_purchase_7": {1: 0.5, 2: None, 3: None, None: None},
    "conversion_cart_to_purchase_30": {1: 0.5, 2: None, 3: None, None: None},
}

SCHEMAS = {
    "customers": "customer_id long, signup_date timestamp_ntz",
    "sessions": "session_id long, customer_id long, start_time timestamp_ntz",
    "events": "event_id long, session_id long, timestamp timestamp_ntz, event_type string, product_id string",
    "orders": "order_id long, customer_id long, order_time timestamp_ntz, total_usd string",
}


def micro_sources(spark, events=EVENTS, sessions=SESSIONS, orders=ORDERS, customers=CUSTOMERS) -> Sources:
    return Sources(
        customers=spark.createDataFrame(customers, SCHEMAS["customers"]),
        sessions=spark.createDataFrame(sessions, SCHEMAS["sessions"]),
        events=spark.createDataFrame(events, SCHEMAS["events"]),
        orders=spark.createDataFrame(orders, SCHEMAS["orders"]),
        run_date=RUN,
    )
