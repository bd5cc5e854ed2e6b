"""The catalog's tables derived from a star schema of orders, parts and events.

Keys are ``bigint`` here; everything else follows the catalog. A line of an
order is the group of rows with its order key and line number, because those
two do not identify a row; the suppliers inside a group are the lots that
serve the line.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.functions.periods import AsOf, window_start
from verdure.sources.catalog import MONEY

# The stored columns of the star schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-15"
# A line's id holds its order key above this many bits and its line number below.
LINE_BITS = 20


def read_star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def line_id(order: str = "l_orderkey", line: str = "l_linenumber") -> Column:
    """Id of a line; fails the job where a number does not fit its bits."""
    fits = (
        F.col(line).between(0, (1 << LINE_BITS) - 1)
        & F.col(order).between(0, (1 << 63 - LINE_BITS) - 1)
    )
    packed = F.col(order) * (1 << LINE_BITS) + F.col(line)
    refused = F.raise_error(F.concat_ws(" ", F.lit("no line id for"), order, line))
    absent = F.col(order).isNull() | F.col(line).isNull()
    return F.when(fits | absent, packed).otherwise(refused.cast("bigint"))


def order_lines(lineitem: DataFrame) -> DataFrame:
    """``sale_detail``: one row per order key and line number."""
    return (
        lineitem.groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("id_flower"),
            F.min("l_quantity").cast("int").alias("amount"),
        )
        .select(line_id().alias("id"), F.col("l_orderkey").alias("id_sale"), "id_flower", "amount")
    )


def lots_of_lines(lineitem: DataFrame) -> DataFrame:
    """``sale_flower``: units per line and supplier."""
    return (
        lineitem.groupBy("l_orderkey", "l_linenumber", "l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("amount"))
        .select(
            line_id().alias("id_sale_detail"),
            F.col("l_suppkey").alias("id_flower_warehouse"),
            "amount",
        )
    )


def priced_lots(supplier: DataFrame) -> DataFrame:
    """``flower_warehouse`` with one lot per supplier, for the price reports."""
    return supplier.select(
        F.col("s_suppkey").alias("id"),
        F.abs(F.col("s_acctbal").cast(MONEY)).cast(MONEY).alias("cost"),
        F.expr("nullif(s_suppkey % 10, 9)").alias("id_greenhouse"),
        (F.col("s_suppkey") * 20).alias("id_flower"),
        (F.col("s_suppkey") % 5 != 0).alias("ready_to_sale"),
        F.lit("2001-01-01").cast("date").alias("date"),
        (F.col("s_suppkey") % 50).cast("int").alias("amount"),
        F.lit(None).cast("string").alias("notes"),
    )


def stock_lots(lineitem: DataFrame) -> DataFrame:
    """``flower_warehouse`` with one lot per part and supplier, for the stock reports."""
    return lineitem.groupBy(
        F.col("l_partkey").alias("id_flower"), F.col("l_suppkey").alias("supplier")
    ).agg(F.sum(F.col("l_quantity").cast("int")).alias("amount")).select(
        "id_flower", "amount", (F.col("supplier") % 5 != 0).alias("ready_to_sale")
    )


def products(part: DataFrame) -> DataFrame:
    """``flower``; some of the parents form cycles."""
    return part.select(
        F.col("p_partkey").alias("id"),
        F.expr("nullif(p_size % 10, 0)").cast("bigint").alias("id_parent"),
        F.col("p_name").alias("name"),
    )


def _address(code: Column, city: Column) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(
        code.cast("string").alias("code"),
        city.alias("city"),
        nothing.alias("street"),
        nothing.alias("phone_number"),
    )


def clients(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``user`` with the nation as the address."""
    home = nation.select("n_nationkey", _address(F.col("n_nationkey"), F.col("n_name")).alias("adress"))
    return customer.join(home, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("e_mail"),
        "adress",
    )


def order_addresses(nation: DataFrame) -> DataFrame:
    """``adress_sale``: one per nation."""
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        _address(F.lit("N"), F.col("n_name")).alias("adress"),
    )


def sales(orders: DataFrame) -> DataFrame:
    """``sale``; one order in 26 has no address of its own."""
    # Status words by status letter.
    status = (
        F.when(F.col("o_orderstatus") == "F", "sent")
        .when(F.col("o_orderstatus") == "O", "not processed")
        .when(F.col("o_orderstatus") == "P", "formation")
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("id_user"),
        F.expr("nullif(o_orderkey % 26, 25)").alias("id_adress"),
        F.col("o_orderdate").alias("buy_date"),
        status.alias("status"),
    )


def treatments(events: DataFrame) -> DataFrame:
    """``prevention``: error events, spread over seven greenhouses."""
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("date").alias("date"),
        (F.col("user_id") % 7).alias("id_greenhouse"),
    )


def greenhouses(supplier: DataFrame) -> DataFrame:
    """``greenhouse``: those that some lot stands in."""
    return (
        supplier.select(F.expr("nullif(s_suppkey % 10, 9)").alias("id")).where("id IS NOT NULL").distinct()
    )


def places(region: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    """A hierarchy of regions, nations and customers as parent pointers."""
    return (
        region.select(
            F.concat(F.lit("r"), "r_regionkey").alias("id"),
            F.lit(None).cast("string").alias("id_parent"),
            F.col("r_name").alias("name"),
        )
        .unionByName(
            nation.select(
                F.concat(F.lit("n"), "n_nationkey").alias("id"),
                F.concat(F.lit("r"), "n_regionkey").alias("id_parent"),
                F.col("n_name").alias("name"),
            )
        )
        .unionByName(
            customer.select(
                F.concat(F.lit("c"), "c_custkey").alias("id"),
                F.concat(F.lit("n"), "c_nationkey").alias("id_parent"),
                F.col("c_name").alias("name"),
            )
        )
    )


class DerivedTables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _lines_of(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of ``lineitem`` of some orders, before anything is grouped.

    Spark moves such a join below a grouping only where it can broadcast.
    """
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return lineitem.join(keys, "l_orderkey", "left_semi")


def sales_tables(
    spark: SparkSession,
    folder: str,
    order: int | None = None,
    as_of: AsOf = None,
    window: str | None = None,
) -> DerivedTables:
    """Tables of the sales and order reports; lots carry prices.

    ``order`` leaves one order and its lines; ``window`` (see ``periods.WINDOWS``)
    the orders from the first day of that window before ``as_of``, and their
    lines. Either cuts the lines at their scan or before their first shuffle,
    and a report over the same window and day has the same result.
    """
    since = None if window is None else window_start(as_of, window)
    read_all = cache(partial(read_star, spark, folder))

    def read(name: str) -> DataFrame:
        rows = read_all(name)
        if name == "orders" and order is not None:
            rows = rows.where(F.col("o_orderkey") == order)
        if name == "orders" and since is not None:
            rows = rows.where(F.col("o_orderdate") >= since.cast("timestamp_ntz"))
        if name == "lineitem" and order is not None:
            rows = rows.where(F.col("l_orderkey") == order)
        if name == "lineitem" and since is not None:
            rows = _lines_of(rows, read("orders"))
        return rows

    return DerivedTables(
        {
            "user": lambda: clients(read("customer"), read("nation")),
            "adress_sale": lambda: order_addresses(read("nation")),
            "flower": lambda: products(read("part")),
            "flower_warehouse": lambda: priced_lots(read("supplier")),
            "sale": lambda: sales(read("orders")),
            "sale_detail": lambda: order_lines(read("lineitem")),
            "sale_flower": lambda: lots_of_lines(read("lineitem")),
        }
    )


def stock_tables(spark: SparkSession, folder: str, sold_before: str | None = None) -> DerivedTables:
    """Tables of the stock reports: lots are part-supplier totals.

    With ``sold_before`` only orders before that date count as sold, and the
    lines of the later orders are under ``new_lines``.
    """
    read = cache(partial(read_star, spark, folder))

    def sale() -> DataFrame:
        all_sales = sales(read("orders"))
        return all_sales if sold_before is None else all_sales.where(F.col("buy_date") < cutoff())

    def cutoff() -> Column:
        return F.lit(sold_before).cast("timestamp_ntz")

    def new_lines() -> DataFrame:
        later = read("orders").where(F.col("o_orderdate") >= cutoff())
        return order_lines(_lines_of(read("lineitem"), later))

    builders = {
        "flower": lambda: products(read("part")),
        "flower_warehouse": lambda: stock_lots(read("lineitem")),
        "sale": sale,
        "sale_detail": lambda: order_lines(read("lineitem")),
    }
    if sold_before is not None:
        builders["new_lines"] = new_lines
    return DerivedTables(builders)


def greenhouse_tables(spark: SparkSession, folder: str) -> DerivedTables:
    """Tables of the greenhouse reports."""
    read = cache(partial(read_star, spark, folder))
    return DerivedTables(
        {
            "flower": lambda: products(read("part")),
            "flower_warehouse": lambda: priced_lots(read("supplier")),
            "greenhouse": lambda: greenhouses(read("supplier")),
            "prevention": lambda: treatments(read("events")),
        }
    )


def flawed_tables(spark: SparkSession, folder: str) -> DerivedTables:
    """Tables with rule violations at fixed keys, for the quality reports.

    Lines and lots stay ungrouped, so repeated keys are those of the data.
    """
    read = cache(partial(read_star, spark, folder))
    return DerivedTables(
        {
            "user": lambda: _flawed_clients(read("customer")),
            "adress_sale": lambda: order_addresses(read("nation")),
            "flower": lambda: products(read("part")),
            "flower_warehouse": lambda: priced_lots(read("supplier")),
            "sale": lambda: _flawed_sales(read("orders")),
            "sale_detail": lambda: _flawed_lines(read("lineitem")),
            "sale_flower": lambda: _ungrouped_lots(read("lineitem")),
        }
    )


def every_flawed_table(spark: SparkSession, folder: str) -> DerivedTables:
    """All 27 tables of the catalog with rule violations at fixed keys."""
    read = cache(partial(read_star, spark, folder))
    some = flawed_tables(spark, folder)

    def of(source: str, *columns: str, **named: str) -> Callable[[], DataFrame]:
        return lambda: read(source).selectExpr(*columns, *(f"{text} AS {name}" for name, text in named.items()))

    def lines(**named: str) -> Callable[[], DataFrame]:
        texts = [f"{text} AS {name}" for name, text in named.items()]
        return lambda: read("lineitem").withColumn("line", line_id()).selectExpr(*texts)

    return DerivedTables(
        {
            **{name: partial(some.__getitem__, name) for name in some},
            "sale_sum": lambda: read("lineitem").selectExpr("CAST(sum(l_quantity) AS BIGINT) AS sum"),
            "dead_flowers": lines(
                id="line",
                id_flower_warehouse="l_suppkey + CASE WHEN l_linenumber = 3 THEN 100000 ELSE 0 END",
                date="CAST(l_shipdate AS DATE)",
                count="CAST(l_quantity AS INT) - 2",
                notes="l_returnflag",
            ),
            "disease": of("part", id="p_partkey", name="p_type", description="p_name", foto="CAST(NULL AS BINARY)"),
            "disease_flower": lines(
                id="line",
                id_flower="l_partkey",
                id_disease="l_suppkey * 30",
                date="CAST(l_shipdate AS DATE)",
                foto="CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_returnflag AS BINARY) END",
                notes="CAST(NULL AS STRING)",
            ),
            "pest": of(
                "supplier", id="s_suppkey", name="CASE WHEN s_suppkey % 30 = 8 THEN repeat(s_name, 2) ELSE s_name END"
            ),
            "pest_flower": lines(
                id="line",
                id_flower="CASE WHEN l_linenumber = 5 THEN -l_partkey ELSE l_partkey END",
                id_pest="l_suppkey * 2",
                date="CAST(l_shipdate AS DATE)",
                foto="CAST(NULL AS BINARY)",
                notes="l_linestatus",
            ),
            "greenhouse": lambda: greenhouses(read("supplier")).selectExpr("id", "id * 3 AS id_staff"),
            "prevention": of(
                "events",
                id="event_id",
                id_staff="nullif(user_id % 20, 11)",
                date="CAST(ts AS DATE)",
                cause="event_type",
                note="CAST(NULL AS STRING)",
                id_greenhouse="user_id % 12",
            ),
            "prevention_detail": of("events", id_preparation="user_id * 3", id_prevention="event_id - event_id % 5"),
            "sheduled_prevention": of(
                "events",
                id="event_id - event_id % 2",
                id_greenhouse="nullif(user_id % 11, 10)",
                date="CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) END",
                cause="event_type",
            ),
            "preparation": of(
                "part", id="p_partkey", id_type="p_size - 1", name="CASE WHEN p_size = 9 THEN repeat(p_name, 4) ELSE p_name END"
            ),
            "preparation_type": of("nation", id="n_nationkey", name="CASE WHEN n_nationkey % 6 = 5 THEN 'other' ELSE n_name END"),
            "position_rate": of(
                "nation",
                id="n_nationkey",
                position="CASE WHEN n_nationkey % 9 = 4 THEN 'gardener' ELSE n_name END",
                rate="CAST((n_nationkey - 2) * 10 AS DECIMAL(19,2))",
            ),
            "staff": of(
                "supplier",
                id="s_suppkey",
                name="CASE WHEN s_suppkey % 50 = 7 THEN NULL WHEN s_suppkey % 45 = 6 THEN concat(s_name, 'xyz') ELSE s_name END",
                surname="CASE WHEN s_suppkey % 40 = 3 THEN repeat(s_name, 2) ELSE s_name END",
                patronymie="CASE WHEN s_suppkey % 3 = 0 THEN repeat(s_name, 2) END",
                id_position="s_nationkey + CASE WHEN s_suppkey % 20 = 9 THEN 900 ELSE 0 END",
                salary="CAST(s_acctbal AS DECIMAL(19,2))",
                allowance="CAST(0 AS DECIMAL(38,2))",
            ),
            "purchase": of(
                "orders",
                id="o_orderkey",
                id_staff="o_custkey % 120",
                date="o_orderdate",
                status=_PURCHASED,
                notes="o_orderpriority",
            ),
            "purchase_detail": lines(
                id_flower="l_partkey",
                id_purchase="l_orderkey - l_orderkey % 4",
                amount="CAST(l_quantity AS INT) - 1",
                cost="CAST(l_extendedprice AS DECIMAL(19,2)) - 5000",
            ),
            "stock": of("part", id="p_partkey", id_type="p_size - 1", name="p_name", amount="p_size - 3"),
            "stock_type": of("nation", id="n_nationkey * 2", name="repeat(n_name, 1 + n_nationkey % 5)"),
            "stock_purchase": of(
                "orders",
                id="o_orderkey",
                id_staff="nullif(o_custkey % 70, 5)",
                date="CAST(o_orderdate AS DATE)",
                status=_PURCHASED,
            ),
            "stock_purchase_detail": lines(
                id_stock="l_partkey + CASE WHEN l_linenumber = 2 THEN 1000000 ELSE 0 END",
                id_stock_purchase="l_orderkey - l_orderkey % 3",
                amount="nullif(CAST(l_quantity AS INT) - 2, 5)",
                cost="CASE WHEN l_linenumber > 1 THEN CAST(l_extendedprice AS DECIMAL(19,2)) - 9000 END",
            ),
        }
    )


# Status words of purchases by status letter; the last is not among the allowed ones.
_PURCHASED = "CASE o_orderstatus WHEN 'F' THEN 'received' WHEN 'O' THEN 'not processed' ELSE 'ordered' END"


def _flawed_clients(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_custkey % 40 <> 3 THEN c_name END AS name",
        "CASE WHEN c_custkey % 30 = 4 THEN repeat(c_mktsegment, 4) ELSE c_mktsegment END AS surname",
        "CASE WHEN c_custkey % 70 = 6 THEN NULL WHEN c_custkey % 60 = 5 THEN 'shared@example.com'"
        " WHEN c_custkey % 50 = 7 THEN lower(c_name)"
        " ELSE concat(lower(c_name), '@example.com') END AS e_mail",
        "named_struct('code', cast(c_nationkey AS string), 'city', repeat(c_mktsegment, 4),"
        " 'street', c_name, 'phone_number', cast(NULL AS string)) AS adress",
    )


def _flawed_sales(orders: DataFrame) -> DataFrame:
    unknown = F.when(F.col("status") == "formation", "on hold").otherwise(F.col("status"))
    return sales(orders).withColumn("status", unknown)


def _flawed_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        line_id().alias("id"),
        F.col("l_orderkey").alias("id_sale"),
        F.expr(
            "CASE WHEN l_partkey % 97 = 0 THEN l_partkey + 1000000000 ELSE nullif(l_partkey, 13) END"
        ).alias("id_flower"),
        (F.col("l_quantity").cast("int") - 1).alias("amount"),
    )


def _ungrouped_lots(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        line_id().alias("id_sale_detail"),
        F.col("l_suppkey").alias("id_flower_warehouse"),
        F.col("l_quantity").cast("int").alias("amount"),
    )
