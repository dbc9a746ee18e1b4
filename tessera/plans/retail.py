"""Shop questions Q1-Q5 and their commented variants.

Each function takes the four shop tables as a dict of DataFrames
(``customers``, ``customer_orders``, ``customer_order_products``,
``products``) so it runs the same on the inline rows and on the driver
tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import anti_null_aware, nested_in, semi
from tessera.sources.sinks import create_table_as, unique_name


def may_customers(tables: dict[str, DataFrame], month: int = 5) -> DataFrame:
    """Q1: names of customers with an order in ``month``: an ``IN`` subquery
    (left-semi join) on a function-wrapped date predicate."""
    orders = tables["customer_orders"].where(F.month("order_date") == month)
    return semi(tables["customers"], orders, "customer_id").select("name")


def customers_without_type(tables: dict[str, DataFrame], product_type: str = "Book") -> DataFrame:
    """Q2: names of customers who never ordered ``product_type``: ``NOT IN``
    over a three-level nested ``IN`` (null-aware anti join over semi joins)."""
    products = tables["products"].where(F.col("product_type") == product_type)
    sub, col = nested_in([
        (tables["customer_orders"], "customer_id", "order_id"),
        (tables["customer_order_products"], "order_id", "product_id"),
        (products, "product_id", None),
    ])
    return anti_null_aware(tables["customers"], sub, "customer_id", col).select("name")


def _lines_with_price(tables: dict[str, DataFrame]) -> DataFrame:
    p, cop = tables["products"], tables["customer_order_products"]
    return p.join(cop, "product_id").select(
        "product_type", "price", "quantity",
        (F.col("price") * F.col("quantity")).alias("revenue"))


def revenue_by_type(tables: dict[str, DataFrame]) -> DataFrame:
    """Q3: revenue per product type, largest first. Price x quantity is
    exact (integer or decimal) and is summed exactly before the final cast."""
    return (_lines_with_price(tables)
            .groupBy("product_type")
            .agg(F.sum("revenue").cast("double").alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_last(), F.col("product_type").asc_nulls_last()))


def revenue_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Q3 variant: the row-level revenue lines, largest first."""
    return (_lines_with_price(tables)
            .select("product_type", F.col("price").cast("double").alias("price"),
                    F.col("quantity").cast("bigint").alias("quantity"),
                    F.col("revenue").cast("double").alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_last(), "product_type", "price", "quantity"))


def products_by_state(tables: dict[str, DataFrame], states: Sequence[str] = ("VA", "MD")) -> DataFrame:
    """Q4: product type, customer name and state for customers in ``states``:
    a four-table inner join chain (one row per order line). The chain starts
    from the filtered customers: inner joins commute, and without table
    statistics Catalyst keeps the written order, so starting from the
    selective side keeps every intermediate proportional to the answer."""
    p, cop = tables["products"], tables["customer_order_products"]
    co, c = tables["customer_orders"], tables["customers"]
    c = c.where(F.col("state").isin(*states))
    return (c.join(co, "customer_id").join(cop, "order_id").join(p, "product_id")
            .select("product_type", "name", "state"))


def product_types_by_state(tables: dict[str, DataFrame], states: Sequence[str] = ("VA", "MD")) -> DataFrame:
    """Q4 variant with nested ``IN``: one row per qualifying *product*, so it
    has fewer columns and no per-line duplicates."""
    c = tables["customers"].where(F.col("state").isin(*states))
    sub, col = nested_in([
        (tables["customer_order_products"], "product_id", "order_id"),
        (tables["customer_orders"], "order_id", "customer_id"),
        (c, "customer_id", None),
    ])
    return semi(tables["products"], sub, "product_id", col).select("product_type")


def _order_lines(tables: dict[str, DataFrame]) -> DataFrame:
    co, cop = tables["customer_orders"], tables["customer_order_products"]
    return co.join(cop, "order_id").select("order_id", "customer_id", "product_id", "quantity")


def _quantity_per_name(customers: DataFrame, lines: DataFrame) -> DataFrame:
    return (customers.join(lines, "customer_id")
            .groupBy("name")
            .agg(F.sum("quantity").cast("bigint").alias("total_quantity"))
            .orderBy(F.col("total_quantity").desc_nulls_last(), F.col("name").asc_nulls_last()))


def quantity_by_customer(tables: dict[str, DataFrame]) -> DataFrame:
    """Q5: items ordered per customer name (names group together), via a
    derived table."""
    return _quantity_per_name(tables["customers"], _order_lines(tables))


def quantity_by_customer_ctas(tables: dict[str, DataFrame], table_name: str | None = None) -> DataFrame:
    """Q5 variant: ``SELECT .. INTO mytable`` first, then the same question
    over the written table."""
    written = create_table_as(_order_lines(tables), table_name or unique_name("mytable"))
    return _quantity_per_name(tables["customers"], written)
