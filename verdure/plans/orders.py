"""Orders: what was ordered, by whom, and what it costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.functions.columns import client_name, delivery_address
from verdure.plans.sales import Tables


def order_info(tables: Tables, id_sale: int | None = None) -> DataFrame:
    """Status, client, delivery address and items of all orders, or of one.

    One row per line; an order without lines has none.
    """
    sale = tables["sale"].select(F.col("id").alias("id_sale"), "id_user", "id_adress", "status")
    lines = tables["sale_detail"].select("id_sale", "id_flower", "amount")
    if id_sale is not None:
        sale = sale.where(F.col("id_sale") == id_sale)
        lines = lines.where(F.col("id_sale") == id_sale)
    users = tables["user"].select(
        F.col("id").alias("id_user"),
        client_name(F.col("name"), F.col("surname")).alias("client"),
        F.col("adress").alias("own_adress"),
    )
    order_addresses = tables["adress_sale"].select(
        F.col("id").alias("found_adress"), F.col("adress").alias("order_adress")
    )
    products = tables["flower"].select(F.col("id").alias("id_flower"), F.col("name").alias("product"))
    headers = (
        sale.join(users, "id_user")
        .join(order_addresses, F.col("id_adress") == F.col("found_adress"), "left")
        .select(
            "id_sale",
            "status",
            "client",
            delivery_address(
                F.col("found_adress"), F.col("order_adress"), F.col("own_adress")
            ).alias("adress"),
        )
    )
    return (
        lines.join(products, "id_flower")
        .join(headers, "id_sale")
        .select("id_sale", "status", "client", "adress", "product", "amount")
    )


def _cost(tables: Tables, per_lot: Column, id_sale: int | None) -> DataFrame:
    prices = tables["flower_warehouse"].select(F.col("id").alias("id_flower_warehouse"), "cost")
    lines = tables["sale_detail"].select(F.col("id").alias("id_sale_detail"), "id_sale")
    sale = tables["sale"].select(F.col("id").alias("id_sale"))
    bridge = tables["sale_flower"].select("id_sale_detail", "id_flower_warehouse", "amount")
    if id_sale is not None:
        lines = lines.where(F.col("id_sale") == id_sale)
        sale = sale.where(F.col("id_sale") == id_sale)
        bridge = bridge.join(lines, "id_sale_detail", "left_semi")
    # Summed per line before the lines are shuffled in, then per order before
    # the orders are.
    per_line = (
        bridge.join(prices, "id_flower_warehouse")
        .groupBy("id_sale_detail")
        .agg(F.sum(per_lot).alias("cost"))
    )
    total = F.sum("cost").cast("decimal(38,2)").alias("cost")
    costs = lines.join(per_line, "id_sale_detail").groupBy("id_sale").agg(total)
    costs = costs.join(sale, "id_sale", "left_semi")
    if id_sale is None:
        return costs
    # One row also for an order without cost, where the sum is NULL.
    return costs.agg(total).select(F.lit(id_sale).alias("id_sale"), "cost")


def order_cost(tables: Tables, id_sale: int | None = None) -> DataFrame:
    """``id_sale, cost``: unit cost of each lot times the units taken from it."""
    return _cost(tables, F.col("cost") * F.col("amount"), id_sale)


def order_unit_cost_sum(tables: Tables, id_sale: int | None = None) -> DataFrame:
    """``id_sale, cost``: unit costs of the lots added up, whatever the amounts."""
    return _cost(tables, F.col("cost"), id_sale)
