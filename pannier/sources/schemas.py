"""Declared schemas; nothing is inferred from the files."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_LONG, _INT, _DOUBLE, _TEXT = LongType(), IntegerType(), DoubleType(), StringType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names, types and order of the tables.
ORDERS = _schema(
    order_id=_LONG,
    user_id=_LONG,
    eval_set=_TEXT,
    order_number=_INT,
    order_dow=_INT,
    order_hour_of_day=_INT,
    days_since_prior_order=_DOUBLE,
)
ORDER_PRODUCTS = _schema(order_id=_LONG, product_id=_LONG, add_to_cart_order=_INT, reordered=_INT)
PRODUCTS = _schema(product_id=_LONG, product_name=_TEXT, department_id=_INT)
DEPARTMENTS = _schema(department_id=_INT, department=_TEXT)

MASTER = _schema(
    order_id=_LONG,
    order_dow=_INT,
    order_hour_of_day=_INT,
    days_since_prior_order=_DOUBLE,
    order_number=_INT,
    product_id=_LONG,
    add_to_cart_order=_INT,
    reordered=_INT,
    product_name=_TEXT,
    department_id=_INT,
    department=_TEXT,
)
RULES = _schema(
    antecedents=ArrayType(_TEXT),
    consequents=ArrayType(_TEXT),
    antecedent_support=_DOUBLE,
    consequent_support=_DOUBLE,
    support=_DOUBLE,
    confidence=_DOUBLE,
    lift=_DOUBLE,
)
CANDIDATES = _schema(
    order_id=_LONG,
    order_dow=_INT,
    order_hour_of_day=_INT,
    days_since_prior_order=_DOUBLE,
    order_number=_INT,
    cart_size=_INT,
    trigger_product_id=_LONG,
    trigger_product_name=_TEXT,
    trigger_reordered=_INT,
    recommended_product_id=_LONG,
    recommended_product_name=_TEXT,
    recommended_department_id=_INT,
    recommended_department_name=_TEXT,
    support=_DOUBLE,
    confidence=_DOUBLE,
    lift=_DOUBLE,
    label=_INT,
)

# The four input tables by name.
TABLES = {
    "orders": ORDERS,
    "order_products": ORDER_PRODUCTS,
    "products": PRODUCTS,
    "departments": DEPARTMENTS,
}
