"""The star-schema tables seen as retail transactions, and the same views as SQL.

``orders_view`` is one row per order, ``lines_view`` one row per purchased line.
Only the tables that the requested columns need are joined. Line amounts are
computed in exact decimals before they become doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.sources.readers import spread_small_scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SEASON = (
    "CASE WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 'Spring' "
    "WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 'Summer' "
    "WHEN month(o_orderdate) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"
)

# logical column -> (tables needed besides orders/lineitem, expression)
_ORDER_COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "customer_id": ((), "o_custkey"),
    "order_id": ((), "o_orderkey"),
    # kept in its stored type, so date filters reach the scan
    "purchase_date": ((), "o_orderdate"),
    "payment_method": ((), "o_orderpriority"),
    "shipping_type": ((), "o_orderstatus"),
    "season": ((), _SEASON),
    "age": ((), "CAST(18 + o_custkey % 53 AS INT)"),
    "gender": ((), "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END"),
    "previous_purchases": ((), "CAST(1 + o_custkey % 50 AS INT)"),
    "subscription": (("customer",), "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END"),
    "location": (("customer", "nation"), "n_name"),
}

_LINE_COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "amount": (
        (),
        "CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) "
        "- CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE)",
    ),
    "quantity": ((), "l_quantity"),
    "price": ((), "l_extendedprice"),
    "rating": ((), "1 + 4 * (l_quantity - 1) / 49"),
    "color": ((), "l_linestatus"),
    "discount_applied": ((), "CASE WHEN l_discount > 0 THEN 'Yes' ELSE 'No' END"),
    "promo_used": ((), "CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END"),
    "category": (("part",), "p_type"),
    "item": (("part",), "p_brand"),
    "size": (
        ("part",),
        "CASE WHEN p_size <= 12 THEN 'Small' WHEN p_size <= 25 THEN 'Medium' "
        "WHEN p_size <= 38 THEN 'Large' ELSE 'Extra' END",
    ),
}

LINE_VIEW_COLUMNS = [*_ORDER_COLUMNS, *_LINE_COLUMNS]
ORDER_VIEW_COLUMNS = [*_ORDER_COLUMNS, "amount"]


def _join_dimensions(df: DataFrame, spark: SparkSession, sf_dir: str, needed: set[str]) -> DataFrame:
    if "part" in needed:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "customer" in needed:
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "nation" in needed:
        df = df.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return df


def orders_view(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order; ``amount`` is the order total."""
    available = {**_ORDER_COLUMNS, "amount": ((), "o_totalprice")}
    names = columns or ("customer_id", "order_id", "purchase_date", "amount")
    needed = {t for n in names for t in available[n][0]}
    orders = spread_small_scan(table(spark, sf_dir, "orders"), "o_orderkey")
    df = _join_dimensions(orders, spark, sf_dir, needed)
    return df.select(*[F.expr(available[n][1]).alias(n) for n in names])


def lines_view(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per purchased line."""
    available = {**_ORDER_COLUMNS, **_LINE_COLUMNS}
    names = columns or tuple(available)
    needed = {t for n in names for t in available[n][0]}
    df = spread_small_scan(table(spark, sf_dir, "lineitem"), "l_orderkey")
    if needed - {"part"} or any(n in _ORDER_COLUMNS for n in names):
        df = df.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = _join_dimensions(df, spark, sf_dir, needed)
    return df.select(*[F.expr(available[n][1]).alias(n) for n in names])


_SQL_CUSTOMER_SIDE = f"""
    o_custkey AS customer_id, o_orderkey AS order_id, CAST(o_orderdate AS TIMESTAMP) AS purchase_date,
    o_orderpriority AS payment_method, o_orderstatus AS shipping_type, {_SEASON} AS season,
    CAST(18 + o_custkey % 53 AS INTEGER) AS age,
    CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CAST(1 + o_custkey % 50 AS INTEGER) AS previous_purchases,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END AS subscription,
    n_name AS location"""

SQL_ORD = f"""ord AS (
  SELECT {_SQL_CUSTOMER_SIDE}, o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

SQL_TX = f"""tx AS (
  SELECT {_SQL_CUSTOMER_SIDE},
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS amount,
    l_quantity AS quantity, l_extendedprice AS price,
    1 + 4 * (l_quantity - 1) / 49 AS rating, l_linestatus AS color,
    CASE WHEN l_discount > 0 THEN 'Yes' ELSE 'No' END AS discount_applied,
    CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS promo_used,
    p_type AS category, p_brand AS item,
    CASE WHEN p_size <= 12 THEN 'Small' WHEN p_size <= 25 THEN 'Medium' WHEN p_size <= 38 THEN 'Large' ELSE 'Extra' END AS size
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""

SQL_RFM_BASE = """rfm AS (
  SELECT customer_id,
    date_diff('day', max(purchase_date), (SELECT max(purchase_date) FROM ord) + INTERVAL 1 DAY) AS recency,
    count(*) AS frequency, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS monetary
  FROM ord GROUP BY customer_id
)"""
