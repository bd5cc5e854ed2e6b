"""A small invented tree nursery; ``plain_reports`` works out results from the same rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from verdure.sources.catalog import CATALOG

AS_OF = dt.date(2024, 9, 30)

# id, parent, name: four levels, of which the last two are sold
FLOWERS = [
    (110, None, "Woody"),
    (120, None, "Aquatic"),
    (211, 110, "Conifer"),
    (212, 110, "Broadleaf"),
    (221, 120, "Marginal"),
    (311, 211, "dwarf pine"),
    (312, 211, "blue cedar"),
    (313, 212, "river birch"),
    (314, 212, "paper birch"),
    (315, 221, "reed mace"),
    (316, 110, "quince"),
    (411, 311, "potted pine"),
    (412, 313, "birch bonsai"),
    (501, 120, "water fern"),
]

# id, product, ready, amount, cost, greenhouse; one stands in the open
LOTS = [
    (6001, 411, True, 40, 75, 8),
    (6003, 411, True, 25, 80, 9),
    (6010, 312, True, 12, 260, 8),
    (6011, 313, False, 30, 55, 9),
    (6020, 314, True, 9, 140, None),
    (6021, 412, True, 50, 31, 7),
    (6030, 315, True, 18, 12, 7),
    (6031, 501, False, 60, 4, 5),
    (6040, 316, True, 33, 95, 5),
]

# id, client, order address, day: both ends of the year and of the month, and days beyond
SALES = [
    (70, 801, 21, "2023-09-30"),
    (71, 802, None, "2023-09-29"),
    (74, 803, 22, "2023-12-24"),
    (75, 801, None, "2024-01-03"),
    (79, 804, 23, "2024-02-29"),
    (82, 802, 22, "2024-05-01"),
    (86, 805, None, "2024-08-30"),
    (87, 803, None, "2024-08-29"),
    (90, 801, 21, "2024-09-15"),
    (93, 804, None, "2024-09-30"),
    (95, 805, 24, "2024-10-02"),
    (99, 805, 24, "2024-06-06"),
]

# id, order, product, amount
LINES = [
    (3000, 70, 411, 4),
    (3005, 70, 312, 1),
    (3010, 71, 411, 6),
    (3015, 74, 314, 2),
    (3020, 74, 412, 9),
    (3025, 75, 315, 5),
    (3030, 79, 411, 3),
    (3035, 79, 316, 7),
    (3040, 82, 312, 1),
    (3045, 86, 313, 8),
    (3050, 87, 412, 6),
    (3055, 90, 411, 8),
    (3060, 90, 314, 1),
    (3065, 93, 501, 10),
    (3070, 95, 315, 2),
    (3075, 82, 316, 12),
]

# line, lot, amount: one line is served from two lots, two lines from none
LINE_LOTS = [
    (3000, 6001, 3),
    (3000, 6003, 1),
    (3005, 6010, 1),
    (3010, 6001, 6),
    (3015, 6020, 2),
    (3020, 6021, 9),
    (3025, 6030, 5),
    (3030, 6003, 3),
    (3035, 6040, 7),
    (3040, 6010, 1),
    (3050, 6021, 6),
    (3055, 6001, 8),
    (3065, 6031, 10),
    (3070, 6030, 2),
    (3075, 6040, 12),
]

GREENHOUSES = [5, 6, 7, 8, 9]

# id, day, greenhouse
TREATMENTS = [
    (40, "2024-08-30", 8),
    (41, "2024-08-29", 9),
    (42, "2024-09-30", 7),
    (43, "2024-09-10", 7),
    (44, "2024-10-01", 5),
]

# id, street; one client gave no address
CLIENTS = [(801, "Elm walk 1"), (802, "Mill pond 7"), (803, "High lea"), (804, None), (805, "Quay 12")]
ADDRESSES = [21, 22, 23, 24]


def address(street: str) -> tuple:
    return ("7040", "Harbour", street, None)


def _frame(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CATALOG[name].schema)


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    users = [(i, f"Given{i}", f"Family{i}", f"u{i}@tree.example", s and address(s)) for i, s in CLIENTS]
    day = dt.date(2024, 3, 3)
    sales = [(i, u, a, dt.datetime.fromisoformat(d), "not processed") for i, u, a, d in SALES]
    lots = [(i, p, r, day, a, Decimal(c), None, g) for i, p, r, a, c, g in LOTS]
    treatments = [(i, 1, dt.date.fromisoformat(d), None, None, g) for i, d, g in TREATMENTS]
    return {
        "user": _frame(spark, "user", users),
        "adress_sale": _frame(spark, "adress_sale", [(i, address(f"Gate {i}")) for i in ADDRESSES]),
        "flower": _frame(spark, "flower", FLOWERS),
        "flower_warehouse": _frame(spark, "flower_warehouse", lots),
        "sale": _frame(spark, "sale", sales),
        "sale_detail": _frame(spark, "sale_detail", LINES),
        "sale_flower": _frame(spark, "sale_flower", LINE_LOTS),
        "greenhouse": _frame(spark, "greenhouse", [(i, 1) for i in GREENHOUSES]),
        "prevention": _frame(spark, "prevention", treatments),
    }
