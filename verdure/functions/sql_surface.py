"""Views and SQL functions, so that SQL text runs unchanged on the reports.

The functions read temporary views of the set-based reports: a call with a
key is a filter that the optimizer pushes into the report's plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from verdure.functions.periods import AsOf
from verdure.operators.hierarchy import full_names
from verdure.plans.orders import order_cost, order_info, order_unit_cost_sum
from verdure.plans.sales import (
    Tables,
    product_sales_last_year,
    revenue_by_month,
    revenue_running_total,
)

# {key}: type of the tables' keys.
_FUNCTIONS = {
    "increment": "(i INT) RETURNS INT RETURN i + 1",
    "cost": "(sale_number {key}) RETURNS DECIMAL(38,2) RETURN"
    " (SELECT max(c.cost) FROM order_cost c WHERE c.id_sale = sale_number)",
    "sale_cost": "(sale_number {key}) RETURNS DECIMAL(38,2) RETURN"
    " (SELECT max(c.cost) FROM order_unit_cost c WHERE c.id_sale = sale_number)",
    "full_name": "(id_flower {key}) RETURNS STRING RETURN"
    " (SELECT max(n.fullname) FROM full_names n WHERE n.id = id_flower)",
    # The column names of the table function.
    "sale_info": "(sale_number {key}) RETURNS TABLE(`Статус заказа` STRING, `ФИО клиента` STRING,"
    " `Адресс доставки` STRUCT<code: STRING, city: STRING, street: STRING, phone_number: STRING>,"
    " `Цветок` STRING, `Количество` {amount}) RETURN"
    " SELECT status, client, adress, product, amount"
    " FROM order_info o WHERE o.id_sale = sale_number",
}


def register_sql_functions(
    spark: SparkSession,
    names: Iterable[str] = tuple(_FUNCTIONS),
    key: str = "INT",
    amount: str = "INT",
) -> None:
    """Register functions by name; all but ``increment`` need the report views.

    ``key`` and ``amount`` are the types that the tables have for them.
    """
    for name in names:
        text = _FUNCTIONS[name].replace("{key}", key).replace("{amount}", amount)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")


def register_sql_surface(spark: SparkSession, tables: Tables, as_of: AsOf = None) -> None:
    """Register the tables, the stored views and the callable functions.

    All of it is lazy: nothing runs before a statement asks for it.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    views = {
        "flower_sum": product_sales_last_year(tables, as_of),
        "sum_for_month": revenue_by_month(tables, as_of),
        "sum_for_year": revenue_running_total(tables, as_of),
        "order_info": order_info(tables),
        "order_cost": order_cost(tables),
        "order_unit_cost": order_unit_cost_sum(tables),
        "full_names": full_names(tables["flower"], one_job=True),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    kinds = [tables["sale"].schema["id"].dataType, tables["sale_detail"].schema["amount"].dataType]
    key, amount = (kind.simpleString() for kind in kinds)
    register_sql_functions(spark, key=key, amount=amount)
