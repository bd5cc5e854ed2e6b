"""Column expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text of the refusal, with the ordered and the available amount.
REFUSAL_FORMAT = "Количество цветов в заказе (%d) превышает количество на складе (%d)"


def increment(value: Column) -> Column:
    """Next integer; past the largest one it fails (ANSI mode) and never wraps."""
    return value.cast("int") + F.lit(1)


def client_name(name: Column, surname: Column) -> Column:
    """Both names with a blank between; NULL if either is NULL."""
    return F.concat(name, F.lit(" "), surname)


def delivery_address(order_address_id: Column, order_address: Column, own: Column) -> Column:
    """Address of the order, or the client's own where the order has none.

    The id decides, not the address: a matched row with an empty address
    still wins.
    """
    return F.when(order_address_id.isNull(), own).otherwise(order_address)


def refusal(ordered: Column, available: Column) -> Column:
    return F.format_string(REFUSAL_FORMAT, ordered.cast("bigint"), available.cast("bigint"))
