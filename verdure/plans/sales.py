"""Sales by product and by month.

``tables`` maps the names of the catalog to DataFrames. Wherever a sale or a
product is only looked up by its key, a semi join stands for the inner join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions.periods import (
    AsOf,
    stored_last_month,
    stored_last_year,
    within_last_month,
    within_last_year,
)
from verdure.operators.identity import dense_ranks
from verdure.operators.joins import not_in
from verdure.operators.ranking import extreme_rows

Tables = Mapping[str, DataFrame]


def _units_sold(
    tables: Tables, as_of: AsOf, calendar: bool = False, dedupe_lots: bool = False
) -> DataFrame:
    sales = within_last_year(tables["sale"], "buy_date", as_of, calendar).select(
        F.col("id").alias("id_sale")
    )
    lines = stored_last_year(tables["sale_detail"], "buy_date", as_of, calendar)
    lines = lines.select("id", "id_sale", "id_flower", "amount")
    lots = (
        stored_last_year(tables["sale_flower"], "buy_date", as_of, calendar)
        .groupBy(F.col("id_sale_detail").alias("id"))
        .agg((F.lit(1) if dedupe_lots else F.count(F.lit(1))).cast("bigint").alias("lots"))
    )
    return (
        lines.join(sales, "id_sale", "left_semi")
        .join(lots, "id")
        .groupBy(F.col("id_flower").alias("flower"))
        .agg(F.sum(F.col("amount") * F.col("lots")).cast("bigint").alias("sum_amount"))
    )


def product_sales_last_year(
    tables: Tables, as_of: AsOf = None, calendar: bool = False, dedupe_lots: bool = False
) -> DataFrame:
    """``flower, sum_amount``: units of each product sold in the last year.

    A line counts once per stock lot that serves it and not at all without a
    lot; ``dedupe_lots`` counts it once.
    """
    products = tables["flower"].select(F.col("id").alias("flower"))
    sold = _units_sold(tables, as_of, calendar, dedupe_lots)
    return sold.join(products, "flower", "left_semi")


def product_sales_ranked(tables: Tables, as_of: AsOf = None, highest: bool = False) -> DataFrame:
    """``flower, sum_amount, rank`` with the dense rank over all products."""
    sold = product_sales_last_year(tables, as_of)
    return dense_ranks(sold, "sum_amount", "rank", highest).select("flower", "sum_amount", "rank")


def _extreme_names(tables: Tables, sold: DataFrame, highest: bool) -> DataFrame:
    # The names are joined before the extreme is sought: both it and the rows
    # then read one and the same shuffle of the sums.
    flower = tables["flower"].select(F.col("id").alias("flower"), "name")
    return extreme_rows(sold.join(flower, "flower"), "sum_amount", highest).select("name")


def least_sold_products(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Names of the products sold least, with ties: rank 1 in ascending order."""
    return _extreme_names(tables, _units_sold(tables, as_of), highest=False)


def best_selling_products(
    tables: Tables, as_of: AsOf = None, calendar: bool = False, dedupe_lots: bool = False
) -> DataFrame:
    """Names of the products sold most, with ties."""
    return _extreme_names(
        tables, _units_sold(tables, as_of, calendar, dedupe_lots), highest=True
    )


def unsold_products_last_month(
    tables: Tables, as_of: AsOf = None, calendar: bool = False
) -> DataFrame:
    """Names of the products below the roots without a sale in the last month."""
    sales = within_last_month(tables["sale"], "buy_date", as_of, calendar).select(
        F.col("id").alias("id_sale")
    )
    lines = stored_last_month(tables["sale_detail"], "buy_date", as_of, calendar)
    sold = lines.join(sales, "id_sale", "left_semi").select("id_flower")
    products = tables["flower"].where(F.col("id_parent").isNotNull()).select("id", "name")
    # Neither key is ever NULL, and a product is listed once.
    return not_in(products, "id", sold, nullable=False, unique=True).select("name")


def revenue_by_month(tables: Tables, as_of: AsOf = None, calendar: bool = False) -> DataFrame:
    """``month, sum``: unit cost of the lots times the amount of the lines.

    Months are numbers, so both ends of a rolling year add up in one month.
    Amounts are summed per lot and month before the lots are joined: a lot
    that serves most lines meets its price once per month.
    """
    sales = within_last_year(tables["sale"], "buy_date", as_of, calendar).select(
        F.col("id").alias("id_sale"), F.month("buy_date").alias("month")
    )
    lines = stored_last_year(tables["sale_detail"], "buy_date", as_of, calendar).select(
        F.col("id").alias("id_sale_detail"), "id_sale", F.col("amount").cast("bigint")
    )
    bridge = stored_last_year(tables["sale_flower"], "buy_date", as_of, calendar)
    bridge = bridge.select("id_sale_detail", "id_flower_warehouse")
    prices = tables["flower_warehouse"].select(F.col("id").alias("id_flower_warehouse"), "cost")
    return (
        lines.join(sales, "id_sale")
        .join(bridge, "id_sale_detail")
        .groupBy("id_flower_warehouse", "month")
        .agg(F.sum("amount").alias("units"))
        .join(prices, "id_flower_warehouse")
        .groupBy("month")
        .agg(F.sum(F.col("cost") * F.col("units")).cast("decimal(38,2)").alias("sum"))
    )


def revenue_running_total(tables: Tables, as_of: AsOf = None, calendar: bool = False) -> DataFrame:
    """``month, sum`` with the sums added up in the order of the month numbers."""
    # At most twelve rows reach the window.
    so_far = F.sum("sum").over(Window.orderBy("month"))
    monthly = revenue_by_month(tables, as_of, calendar)
    return monthly.select("month", so_far.cast("decimal(38,2)").alias("sum"))
