"""Golden answers for the shop questions on the inline rows (FIXTURES.md 1)."""

from __future__ import annotations

import pytest

from tessera.plans import retail
from tessera.sources.inline import shop_fixture


@pytest.fixture(scope="module")
def shop(spark):
    return shop_fixture(spark)


def names(df):
    return sorted(r[0] for r in df.collect())


def test_q1_may(shop):
    # the one answer stated with the question
    assert names(retail.may_customers(shop)) == ["Charlie", "Mark"]


def test_q2_no_books(shop):
    assert names(retail.customers_without_type(shop, "Book")) == ["Mark", "Matt", "Sachin"]


def test_q3_revenue_by_type_in_order(shop):
    got = [tuple(r) for r in retail.revenue_by_type(shop).collect()]
    assert got == [("Board Game", 100.0), ("Book", 75.0), ("Water Bottle", 50.0), ("Socks", 10.0)]


def test_q3_rows(shop):
    got = [tuple(r) for r in retail.revenue_rows(shop).collect()]
    assert got[0] == ("Board Game", 25.0, 4, 100.0)
    assert sorted(got) == sorted([("Board Game", 25.0, 4, 100.0), ("Water Bottle", 10.0, 5, 50.0),
                                  ("Book", 15.0, 3, 45.0), ("Book", 15.0, 2, 30.0),
                                  ("Socks", 5.0, 2, 10.0)])


def test_q4_join_form(shop):
    got = sorted(tuple(r) for r in retail.products_by_state(shop).collect())
    assert got == sorted([("Book", "Kim", "VA"), ("Board Game", "Kim", "VA"), ("Socks", "Matt", "VA")])


def test_q4_nested_in_form_has_no_duplicates(shop):
    assert names(retail.product_types_by_state(shop)) == ["Board Game", "Book", "Socks"]


def test_q5_and_ctas_variant_agree(shop):
    q5 = [tuple(r) for r in retail.quantity_by_customer(shop).collect()]
    assert q5[:2] == [("Kim", 46), ("Mark", 5)]
    assert sorted(q5[2:]) == [("Charlie", 2), ("Matt", 2)]
    assert "Sachin" not in dict(q5)
    ctas = sorted(tuple(r) for r in retail.quantity_by_customer_ctas(shop).collect())
    assert ctas == sorted(q5)


def test_dangling_product_is_lost_in_inner_joins_and_reported(shop):
    from tessera.operators.quality import orphans
    bad = orphans(shop["customer_order_products"], "product_id", shop["products"], "product_id")
    assert [(r.order_id, r.product_id) for r in bad.collect()] == [(40, 41)]
