"""Stock: what is left of each product, and which order lines it allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.operators.admission import admit_one_by_one, check_running_demand
from verdure.operators.joins import lookup_total
from verdure.plans.sales import Tables


def _sold_lines(tables: Tables, trust_orders: bool) -> DataFrame:
    lines = tables["sale_detail"].select("id_sale", "id_flower", "amount")
    if trust_orders:
        return lines
    return lines.join(tables["sale"].select(F.col("id").alias("id_sale")), "id_sale", "left_semi")


def available_stock(
    tables: Tables, trust_orders: bool = False, sold_units: DataFrame | None = None
) -> DataFrame:
    """``id_flower, ready, sold, available`` of every product with a lot or a sale.

    Ready are the units of all lots marked so; sold are the units of all lines
    ever, of any date and status. Both sides are added up in one aggregation.
    ``trust_orders`` saves the look-up of the orders where no line lacks one.
    ``sold_units`` (``id_flower, units``), the stored totals, stands for the
    lines, and they are not read at all.
    """
    ready = F.when(F.col("ready_to_sale").eqNullSafe(True), F.col("amount")).otherwise(0)
    lots = tables["flower_warehouse"].select(
        "id_flower", ready.cast("bigint").alias("ready"), F.lit(0).cast("bigint").alias("sold")
    )
    if sold_units is None:
        lines = _sold_lines(tables, trust_orders)
    else:
        lines = sold_units.select("id_flower", F.col("units").alias("amount"))
    sold = lines.select(
        "id_flower", F.lit(0).cast("bigint").alias("ready"), F.col("amount").cast("bigint").alias("sold")
    )
    return (
        lots.unionByName(sold)
        .groupBy("id_flower")
        .agg(
            # Lots or lines without any amount count as none.
            F.coalesce(F.sum("ready"), F.lit(0)).alias("ready"),
            F.coalesce(F.sum("sold"), F.lit(0)).alias("sold"),
        )
        .withColumn("available", F.col("ready") - F.col("sold"))
    )


def products_with_stock(tables: Tables) -> DataFrame:
    """Every product with its ready units; 0 for a product without a ready lot."""
    lots = tables["flower_warehouse"].where(F.col("ready_to_sale").eqNullSafe(True))
    return lookup_total(
        tables["flower"].select("id", "name"), "id", lots, "id_flower", "amount", "ready"
    )


def check_order_lines(tables: Tables, new_lines: DataFrame, trust_orders: bool = False) -> DataFrame:
    """Check new lines, inserted together in the order of ``id``, against the stock."""
    return check_running_demand(new_lines, available_stock(tables, trust_orders))


def admit_order_lines(tables: Tables, new_lines: DataFrame, trust_orders: bool = False) -> DataFrame:
    """Admit new lines one by one in the order of ``id``; refused ones use no stock."""
    return admit_one_by_one(new_lines, available_stock(tables, trust_orders))
