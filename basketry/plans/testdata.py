"""Clickstream views of the driver's tables.

``events`` gives a dense stream (about a hundred products, one month); ``lineitem`` gives a
sparse one with many products and years of days. ``dirty_bronze`` turns the dense stream
back into text with every kind of fault that cleaning must handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.settings import EVENT_COLUMNS, EVENT_TYPES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as shop events; ``signup`` stays an invalid type."""
    keyed = _table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(ts as timestamp) AS event_time",
        "event_type",
        "cast(get_json_object(props, '$.k') as bigint) AS k",
        "value",
        "user_id",
    )
    return keyed.selectExpr(
        "event_id",
        "event_time",
        "CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart' "
        "ELSE event_type END AS event_type",
        "k AS product_id",
        "k % 10 AS category_id",
        "concat('dept.', k % 10) AS category_code",
        "concat('brand-', user_id % 7) AS brand",
        "value AS price",
        "user_id",
        "concat(user_id, '-', date_format(event_time, 'yyyyMMdd')) AS user_session",
    )


def click_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, valid events with their day."""
    events = click_events(spark, sf_dir).where(F.col("event_type").isin(*EVENT_TYPES))
    return events.select(*EVENT_COLUMNS, F.to_date("event_time").alias("date"))


def lineitem_silver(spark: SparkSession, sf_dir: str, with_user: bool = False) -> DataFrame:
    """Order lines as events: returned = view, none = cart, accepted = purchase."""
    lines = _table(spark, sf_dir, "lineitem")
    columns = [
        "cast(l_shipdate as timestamp) AS event_time",
        "CASE l_returnflag WHEN 'R' THEN 'view' WHEN 'N' THEN 'cart' ELSE 'purchase' END "
        "AS event_type",
        "l_partkey AS product_id",
        "l_extendedprice / l_quantity AS price",
        "to_date(l_shipdate) AS date",
    ]
    if with_user:
        orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        columns.append("o_custkey AS user_id")
    return lines.selectExpr(*columns)


# Faults by event_id: each entry is (column, modulus, remainder, replacement SQL).
_FAULTS = {
    "event_time": [
        (97, 1, "'bad-time'"),
        (101, 1, "'10:00'"),
        (103, 1, "'2019'"),
        (107, 1, "'NaN'"),
        (19, 2, "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"),
        (23, 2, "date_format(event_time, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"),
        (29, 2, "date_format(event_time, 'yyyy-MM-dd HH:mm:ss')"),
    ],
    "event_type": [
        (89, 1, "'n/a'"),
        (5, 2, "concat(' \\t', upper(event_type), ' ')"),
        (83, 1, "'unknown'"),
    ],
    "price": [
        (31, 1, "'-5.0'"),
        (37, 1, "'NaN'"),
        (41, 1, "'1.0d'"),
        (43, 1, "'abc'"),
        (47, 1, "'0'"),
        (53, 1, "'1e2'"),
        (59, 1, "' 12.5 '"),
        (61, 1, "'inf'"),
    ],
    "product_id": [
        (67, 1, "concat(product_id, '.5')"),
        (71, 1, "'<NA>'"),
        (73, 1, "'x7'"),
        (79, 1, "concat(product_id, '.0')"),
    ],
    "category_id": [(7, 3, "'2053013555631882655'"), (109, 1, "'1e30'")],
    "category_code": [(11, 1, "' '"), (13, 1, "'None '"), (17, 1, "'NULL'"), (6, 1, "' a.b '")],
    "brand": [(11, 3, "''"), (13, 3, "' nan'"), (17, 3, "'#N/A'"), (6, 3, "'\\tpadded'")],
    "user_id": [(113, 1, "'null'")],
    "user_session": [(14, 1, "' s '"), (15, 1, "'None'")],
}


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click events as text cells with faults, copies and near-copies, plus ``event_id``.

    ``source_file`` says which of two raw files a row belongs to.
    """
    plain = {
        **{c: f"cast({c} as string)" for c in EVENT_COLUMNS},
        "event_time": "concat(date_format(event_time, 'yyyy-MM-dd HH:mm:ss'), ' UTC')",
    }
    cells = []
    for column in EVENT_COLUMNS:
        faults = "".join(
            f" WHEN event_id % {m} = {r} THEN {value}" for m, r, value in _FAULTS.get(column, [])
        )
        text = f"CASE{faults} ELSE {plain[column]} END" if faults else plain[column]
        cells.append(f"{text} AS {column}")
    half = "CASE WHEN day(event_time) <= 15 THEN 'first-half' ELSE 'second-half' END AS source_file"
    rows = click_events(spark, sf_dir).selectExpr("event_id", *cells, half)
    copies = rows.where("event_id % 10 = 3")
    # equal after cleaning only, and in the other file
    near = rows.where("event_id % 10 = 4").selectExpr(
        "event_id",
        *[
            "concat(upper(event_type), ' ') AS event_type" if c == "event_type" else c
            for c in EVENT_COLUMNS
        ],
        "'second-half' AS source_file",
    )
    return rows.unionByName(copies).unionByName(near)
