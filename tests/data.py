"""Small inputs shared by the tests."""

from __future__ import annotations

import datetime as dt

from basketry.settings import EVENT_COLUMNS

# Twelve raw rows: ten good ones, one bad time (row 10), one unknown type (row 11).
RAW = [
    ("2024-03-01 10:00:00 UTC", "view", "7", "70", "home.lamp", "lumo", "19.5", "1", "a"),
    ("2024-03-01 10:01:00 UTC", "cart", "7", "70", "home.lamp", "lumo", "19.5", "1", "a"),
    ("2024-03-01 10:02:00 UTC", "purchase", "7", "70", "home.lamp", "lumo", "19.5", "1", "a"),
    ("2024-03-01 11:30:00 UTC", "view", "7", "70", "home.lamp", "lumo", "19.5", "2", "b"),
    ("2024-03-01 11:35:00 UTC", "view", "8", "80", "food.tea", "", "4.0", "2", "b"),
    ("2024-03-02 09:00:00 UTC", "view", "8", "80", "food.tea", "", "4.0", "3", "c"),
    ("2024-03-02 09:10:00 UTC", "cart", "8", "80", "food.tea", "", "4.0", "3", "c"),
    ("2024-03-02 09:20:00 UTC", "purchase", "8", "80", "food.tea", "", "4.0", "3", "c"),
    ("2024-03-02 13:00:00 UTC", "remove_from_cart", "7", "70", "home.lamp", "lumo", "19.5", "1", "d"),
    ("not-a-time", "view", "7", "70", "home.lamp", "lumo", "19.5", "4", "e"),
    ("2024-03-03 08:00:00 UTC", "wishlist", "7", "70", "home.lamp", "lumo", "19.5", "5", "f"),
    ("2024-03-03 09:00:00 UTC", "view", "7", "70", "home.lamp", "lumo", "19.5", "1", "a"),
]


def raw_frame(spark, rows=RAW):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in EVENT_COLUMNS))


def day(n: int, start: str = "2024-01-01") -> dt.date:
    return dt.date.fromisoformat(start) + dt.timedelta(days=n)


def daily_frame(spark, rows):
    """(product_id, date, views, carts, removals, purchases) rows."""
    return spark.createDataFrame(
        rows, "product_id long, date date, views long, carts long, removals long, purchases long"
    )
