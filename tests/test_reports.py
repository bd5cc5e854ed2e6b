from __future__ import annotations

import datetime as dt
from decimal import Decimal

import plain_reports as plain
import pytest
from nursery_rows import AS_OF, FLOWERS, LINES, LOTS

from verdure.operators.hierarchy import full_names
from verdure.plans import greenhouses, orders, sales, stock

LONG_AGO = "1990-01-01"


def pairs(df):
    return {row[0]: row[1] for row in df.collect()}


def names(df):
    return sorted(row[0] for row in df.collect())


def test_product_sales(nursery):
    expected = plain.units_sold(plain.YEAR)
    assert expected == {411: 19, 312: 2, 314: 2, 412: 15, 315: 5, 316: 19, 501: 10}
    assert pairs(sales.product_sales_last_year(nursery, AS_OF)) == expected


def test_product_sales_of_the_calendar_year(nursery):
    expected = plain.units_sold(lambda day: day.year == 2023)
    result = sales.product_sales_last_year(nursery, "2024-05-05", calendar=True)
    assert pairs(result) == expected and expected[411] == 14


def test_a_line_counts_once_per_lot(nursery):
    assert pairs(sales.product_sales_last_year(nursery, AS_OF))[411] == 2 * 4 + 3 + 8
    once = pairs(sales.product_sales_last_year(nursery, AS_OF, dedupe_lots=True))
    assert once == plain.units_sold(plain.YEAR, once=True) and once[411] == 4 + 3 + 8


def test_ranking(nursery):
    sold = plain.units_sold(plain.YEAR)
    assert names(sales.least_sold_products(nursery, AS_OF)) == plain.extreme(sold, min) == ["blue cedar", "paper birch"]
    assert names(sales.best_selling_products(nursery, AS_OF)) == plain.extreme(sold, max) == ["potted pine", "quince"]
    ranked = {r.flower: r["rank"] for r in sales.product_sales_ranked(nursery, AS_OF).collect()}
    levels = sorted(set(sold.values()))
    assert ranked == {product: levels.index(n) + 1 for product, n in sold.items()}


def test_no_sales_no_ranking(nursery):
    assert names(sales.best_selling_products(nursery, LONG_AGO)) == []


def test_unsold(nursery):
    expected = plain.unsold(plain.MONTH)
    assert names(sales.unsold_products_last_month(nursery, AS_OF)) == expected
    assert "river birch" not in expected and "birch bonsai" in expected


def test_unsold_in_calendar_month(nursery):
    expected = plain.unsold(lambda day: (day.year, day.month) == (2024, 9))
    assert names(sales.unsold_products_last_month(nursery, AS_OF, calendar=True)) == expected


def test_unsold_without_any_sale_lists_all_below_the_roots(nursery):
    expected = sorted(n for _, p, n in FLOWERS if p is not None)
    assert names(sales.unsold_products_last_month(nursery, LONG_AGO)) == expected


def test_revenue(nursery):
    expected = plain.revenue(plain.YEAR)
    # September holds both ends: 4 x (75 + 80) + 260 of one year, 8 x 75 + 10 x 4 of the next.
    assert expected[9] == 620 + 260 + 600 + 40
    assert pairs(sales.revenue_by_month(nursery, AS_OF)) == expected
    assert pairs(sales.revenue_running_total(nursery, AS_OF)) == plain.running(expected)


def test_both_ends_of_the_year_share_a_month(spark, nursery):
    sale = spark.createDataFrame(
        [
            (190, 801, None, dt.datetime(2023, 9, 30), "sent"),  # first moment inside
            (191, 801, None, dt.datetime(2023, 9, 29, 23, 59), "sent"),  # outside
            (192, 801, None, dt.datetime(2024, 9, 30, 8, 0), "sent"),  # later on the day: outside
            (193, 801, None, dt.datetime(2024, 9, 30), "sent"),  # last moment inside
        ],
        nursery["sale"].schema,
    )
    lines = spark.createDataFrame([(9000 + i, 190 + i, 315, 1) for i in range(4)], nursery["sale_detail"].schema)
    lots = spark.createDataFrame([(9000 + i, 6030, 1) for i in range(4)], nursery["sale_flower"].schema)
    tables = {
        **nursery,
        "sale": nursery["sale"].unionByName(sale),
        "sale_detail": nursery["sale_detail"].unionByName(lines),
        "sale_flower": nursery["sale_flower"].unionByName(lots),
    }
    assert pairs(sales.revenue_by_month(tables, AS_OF))[9] == plain.revenue(plain.YEAR)[9] + 2 * 12


def test_order_info(nursery):
    rows = orders.order_info(nursery, 74).collect()
    assert sorted((r["product"], r["amount"]) for r in rows) == [("birch bonsai", 9), ("paper birch", 2)]
    assert {(r["client"], r["adress"]["street"], r["status"]) for r in rows} == {
        ("Given803 Family803", "Gate 22", "not processed")
    }


def test_order_without_address_uses_the_clients(nursery):
    rows = orders.order_info(nursery, 87).collect()
    assert [(r["adress"]["street"], r["product"], r["amount"]) for r in rows] == [("High lea", "birch bonsai", 6)]
    # Neither the order nor its client has one.
    assert [r["adress"] for r in orders.order_info(nursery, 93).collect()] == [None]


def test_matched_address_wins_even_if_it_is_null(spark, nursery):
    empty = spark.createDataFrame([(22, None)], nursery["adress_sale"].schema)
    rows = orders.order_info({**nursery, "adress_sale": empty}, 74).collect()
    assert {r["adress"] for r in rows} == {None}


def test_order_without_lines_has_no_rows(nursery):
    assert orders.order_info(nursery, 99).count() == 0


def test_order_info_of_all_orders(nursery):
    assert orders.order_info(nursery).count() == len(LINES)


def test_order_cost(nursery):
    expected = plain.costs()
    assert pairs(orders.order_cost(nursery)) == expected
    assert expected[70] == 3 * 75 + 80 + 260
    assert orders.order_cost(nursery, 70).collect() == [(70, Decimal("565.00"))]
    assert orders.order_cost(nursery, 999).collect() == [(999, None)]


def test_order_unit_cost_sum(nursery):
    expected = plain.costs(by_amount=False)
    assert pairs(orders.order_unit_cost_sum(nursery)) == expected and expected[70] == 75 + 80 + 260
    assert orders.order_unit_cost_sum(nursery, 86).collect() == [(86, None)]


def test_untreated_lots(nursery):
    listed = [r["lot_id"] for r in greenhouses.untreated_lots(nursery, AS_OF).collect()]
    assert listed == plain.untreated(plain.MONTH) == [6003, 6011, 6031, 6040]


def test_lot_without_greenhouse(nursery):
    never = sorted(r["lot_id"] for r in greenhouses.untreated_lots(nursery, LONG_AGO).collect())
    assert never == sorted(lot[0] for lot in LOTS) and 6020 in never


def test_treatment_counts(nursery):
    assert pairs(greenhouses.treatment_counts(nursery, AS_OF)) == plain.treated(plain.MONTH) == {7: 2, 8: 1}


@pytest.mark.parametrize("one_job", [False, True])
def test_full_names(nursery, one_job):
    found = pairs(full_names(nursery["flower"], one_job=one_job))
    assert found == {i: plain.full_name(i) for i, _, _ in FLOWERS}
    assert found[412] == " Broadleaf river birch birch bonsai"


def test_available_stock(nursery):
    expected = plain.stock()
    assert expected[313] == -8 and expected[411] == 65 - 21
    for trust in (False, True):
        result = stock.available_stock(nursery, trust_orders=trust).collect()
        assert {r["id_flower"]: r["available"] for r in result} == expected


@pytest.mark.parametrize(
    ("product", "amount", "ok", "available"),
    [(314, 6, True, 6), (314, 7, False, 6), (313, 1, False, -8), (777, 1, False, 0)],
)
def test_check_order_line(spark, nursery, product, amount, ok, available):
    line = spark.createDataFrame([(9000, 95, product, amount)], nursery["sale_detail"].schema)
    row = stock.check_order_lines(nursery, line).collect()[0]
    assert (row["ok"], row["available"]) == (ok, available)
    assert (row["message"] is None) == ok
    if not ok:
        assert f"({amount})" in row["message"] and row["message"].endswith(f"({available})")


def test_products_with_stock(nursery):
    ready = {r["id"]: r["ready"] for r in stock.products_with_stock(nursery).collect()}
    assert len(ready) == len(FLOWERS) and (ready[411], ready[501], ready[110]) == (65, 0, 0)
