"""Preventive treatments of greenhouses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.functions.periods import AsOf, within_last_month
from verdure.operators.joins import not_in
from verdure.plans.sales import Tables


def treatment_counts(tables: Tables, as_of: AsOf = None, calendar: bool = False) -> DataFrame:
    """``id_greenhouse, treatments`` of the greenhouses treated in the last month.

    Greenhouses without a treatment in the window have no row: the window is
    a condition on the treatment. Counted before the greenhouses are joined.
    """
    recent = within_last_month(tables["prevention"], "date", as_of, calendar)
    counted = recent.groupBy("id_greenhouse").agg(F.count("id").alias("treatments"))
    houses = tables["greenhouse"].select(F.col("id").alias("id_greenhouse"))
    return counted.join(houses, "id_greenhouse", "left_semi")


def untreated_lots(
    tables: Tables, as_of: AsOf = None, calendar: bool = False, ordered: bool = True
) -> DataFrame:
    """``lot_id, name`` of the lots in greenhouses without a recent treatment.

    A lot without a greenhouse is listed only if no greenhouse was treated.
    """
    treated = treatment_counts(tables, as_of, calendar).select("id_greenhouse")
    lots = tables["flower_warehouse"].select(
        F.col("id").alias("lot_id"), "id_flower", "id_greenhouse"
    )
    products = tables["flower"].select(F.col("id").alias("id_flower"), "name")
    listed = (
        not_in(lots, "id_greenhouse", treated).join(products, "id_flower").select("lot_id", "name")
    )
    return listed.orderBy("lot_id") if ordered else listed
