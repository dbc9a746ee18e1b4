"""Declared schemas and inline literal rows.

The shop questions come with their own four small tables. They are used by
the golden tests; registered queries run the same functions over the driver
tables through ``stand_ins.shop_tables``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SHOP_SCHEMAS = {
    "customers": T.StructType([
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
    ]),
    "customer_orders": T.StructType([
        T.StructField("order_id", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
    ]),
    "customer_order_products": T.StructType([
        T.StructField("order_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("price", T.IntegerType()),
    ]),
}

# The shop rows exactly as inserted by the source script.
SHOP_ROWS = {
    "customers": [
        (41, "Matt", "VA"),
        (42, "Sachin", "MD"),
        (43, "Kim", "VA"),
        (44, "Charlie", "CA"),
        (45, "Mark", "CA"),
    ],
    "customer_orders": [
        (36, 42, dt.date(2018, 4, 1)),
        (37, 43, dt.date(2018, 4, 7)),
        (38, 45, dt.date(2018, 5, 1)),
        (39, 44, dt.date(2018, 5, 15)),
        (40, 43, dt.date(2018, 6, 2)),
        (41, 41, dt.date(2018, 7, 12)),
    ],
    "customer_order_products": [
        (37, 314, 3),
        (38, 421, 5),
        (37, 510, 4),
        (40, 41, 39),
        (41, 425, 2),
        (39, 314, 2),
    ],
    "products": [
        (314, "Book", 15),
        (421, "Water Bottle", 10),
        (510, "Board Game", 25),
        (689, "Soccer Ball", 20),
        (425, "Socks", 5),
    ],
}


def inline_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(SHOP_ROWS[name], SHOP_SCHEMAS[name])


def shop_fixture(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: inline_table(spark, name) for name in SHOP_SCHEMAS}
