"""Table schemas and the mapping from logical roles to column names."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnMap:
    """Which column plays which role in a transaction table."""

    customer: str = "customer_id"
    order: str = "order_id"
    date: str = "purchase_date"
    amount: str = "amount"
    category: str = "category"
    item: str = "item"
    rating: str = "rating"
    payment: str = "payment_method"
    season: str = "season"
    size: str = "size"
    color: str = "color"
    shipping: str = "shipping_type"
    discount: str = "discount_applied"
    promo: str = "promo_used"
    age: str = "age"
    gender: str = "gender"
    location: str = "location"
    subscription: str = "subscription"
    previous: str = "previous_purchases"


DEFAULT_COLUMNS = ColumnMap()


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(spec: str, required: tuple[str, ...] = ()) -> T.StructType:
    """``"name TYPE, ..."`` as a StructType (DDL parsing would need a running session)."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in required) for n, t in pairs])


# The retail file: one row per purchase, raw column names.
RAW_RETAIL = T.StructType(
    [
        T.StructField(name, dtype, True)
        for name, dtype in [
            ("Customer ID", T.LongType()),
            ("Age", T.IntegerType()),
            ("Gender", T.StringType()),
            ("Item Purchased", T.StringType()),
            ("Category", T.StringType()),
            ("Purchase Amount (USD)", T.DoubleType()),
            ("Location", T.StringType()),
            ("Size", T.StringType()),
            ("Color", T.StringType()),
            ("Season", T.StringType()),
            ("Review Rating", T.DoubleType()),
            ("Subscription Status", T.StringType()),
            ("Payment Method", T.StringType()),
            ("Shipping Type", T.StringType()),
            ("Discount Applied", T.StringType()),
            ("Promo Code Used", T.StringType()),
            ("Previous Purchases", T.IntegerType()),
            ("Preferred Payment Method", T.StringType()),
            ("Frequency of Purchases", T.StringType()),
            ("Purchase Date", T.TimestampType()),
        ]
    ]
)

RAW_TO_CANONICAL = {
    "Customer ID": "customer_id",
    "Age": "age",
    "Gender": "gender",
    "Item Purchased": "item",
    "Category": "category",
    "Purchase Amount (USD)": "amount",
    "Location": "location",
    "Size": "size",
    "Color": "color",
    "Season": "season",
    "Review Rating": "rating",
    "Subscription Status": "subscription",
    "Payment Method": "payment_method",
    "Shipping Type": "shipping_type",
    "Discount Applied": "discount_applied",
    "Promo Code Used": "promo_used",
    "Previous Purchases": "previous_purchases",
    "Purchase Date": "purchase_date",
}

# Upload contract: three required columns, two optional ones.
UPLOAD = _schema(
    "customer_id STRING, purchase_date TIMESTAMP, purchase_amount DOUBLE, category STRING, review_rating DOUBLE",
    required=("customer_id", "purchase_date", "purchase_amount"),
)

# The four relational tables.
TABLES: dict[str, T.StructType] = {
    "customers": _schema(
        "customer_id STRING, age INT, gender STRING, location STRING, subscription_status STRING, "
        "created_date TIMESTAMP, updated_date TIMESTAMP"
    ),
    "transactions": _schema(
        "transaction_id STRING, customer_id STRING, item_purchased STRING, category STRING, "
        "purchase_amount DOUBLE, purchase_date TIMESTAMP, review_rating DOUBLE, "
        "payment_method STRING, created_date TIMESTAMP"
    ),
    "customer_segments": _schema(
        "segment_id INT, customer_id STRING, segment_label INT, segment_name STRING, "
        "rfm_score STRING, created_date TIMESTAMP, model_version STRING"
    ),
    "model_predictions": _schema(
        "prediction_id INT, customer_id STRING, model_name STRING, prediction_type STRING, "
        "prediction_value DOUBLE, prediction_probability DOUBLE, prediction_date TIMESTAMP, "
        "model_version STRING"
    ),
}


def to_canonical(raw: DataFrame) -> DataFrame:
    """Rename the raw retail columns; columns outside the map are kept as they are."""
    return raw.withColumnsRenamed({k: v for k, v in RAW_TO_CANONICAL.items() if k in raw.columns})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def datetime_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def columns_named(df: DataFrame, *parts: str) -> list[str]:
    """Columns whose name contains one of the texts, in any case."""
    return [c for c in df.columns if any(p.lower() in c.lower() for p in parts)]


def few_values(df: DataFrame, column: str, limit: int = 1000) -> None:
    """Refuse a label column with more than ``limit`` values before anything per label is gathered."""
    if df.select(column).distinct().limit(limit + 1).count() > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")


def literal_for(df: DataFrame, column: str, value: Any) -> Column:
    """A bound as literal of the column's own time type.

    Comparing different time types would cast the column and keep the filter
    away from the files; other literals are compared as they are.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(value)
    # a date without zone means the clock time that the column shows, in any session zone
    if isinstance(value, dt.date) and getattr(value, "tzinfo", None) is None:
        value = value.isoformat()
    return F.lit(value).cast(kind)


def in_years(df: DataFrame, column: str, first: int, last: int) -> Column:
    """Dates of whole years as a range on the stored type, which reaches the files (``year(column)`` would not)."""
    begin, end = dt.date(first, 1, 1), dt.date(last + 1, 1, 1)
    return (F.col(column) >= literal_for(df, column, begin)) & (F.col(column) < literal_for(df, column, end))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def require(df: DataFrame, *names: str) -> None:
    """A missing column is an error; nothing is ever filled with random values."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
