
from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file may be loaded by path from another folder.
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles
from verdure.functions.columns import increment
from verdure.functions.sql_surface import register_sql_functions, register_sql_surface
from verdure.operators import cascade, quality
from verdure.operators.admission import admit_one_by_one, require_accepted
from verdure.operators.hierarchy import full_names
from verdure.operators.identity import assign_ids, fill_defaults
from verdure.plans import greenhouses, orders, sales, stock
from verdure.sources import decoders, star_schema, store, totals
from verdure.sources.catalog import CATALOG
from verdure.sources.lineage import checkpoint_folder
from verdure.streaming.admission_stream import (
    admission_stream,
    decided_lines,
    keyed_admission_stream,
)

# The training-data operators are a part that can be left out; errors inside it are not swallowed.
training_data = None
if find_spec("verdure.llm") is not None and find_spec("verdure.llm.registry") is not None:
    from verdure.llm import registry as training_data

AS_OF = star_schema.ORDERS_AS_OF
TREATED_AS_OF = star_schema.EVENTS_AS_OF
SOLD_BEFORE = "1998-01-01"
YEAR, CALENDAR, MONTH = "year", "calendar year", "month"
# Tables that the price of an order needs.
_SOLD = ("sale", "sale_detail", "sale_flower", "flower_warehouse")
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by month with its running total on the smallest data set."""
    return _of_sales(sales.revenue_running_total, YEAR, as_of=AS_OF)(spark, "/root/testdata/sf0.001")


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/verdure-{uuid.uuid4().hex}"


def _of_sales(report: Callable[..., DataFrame], window: str | None = None, **options) -> Query:
    """A report on the orders of its window, cut before the lines are first shuffled."""
    return lambda spark, sf: report(
        star_schema.sales_tables(spark, sf, as_of=options.get("as_of"), window=window), **options
    )


def _of_order(report: Callable[..., DataFrame], order: int) -> Query:
    return lambda spark, sf: report(
        star_schema.sales_tables(spark, sf, order=order), id_sale=order
    )


def _of_greenhouses(report: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf: report(star_schema.greenhouse_tables(spark, sf), **options)


def _flat_order_info(spark: SparkSession, sf: str) -> DataFrame:
    info = orders.order_info(star_schema.sales_tables(spark, sf))
    return info.select(
        "id_sale", "status", "client", "adress.code", "adress.city", "product", "amount"
    )


def _one_order(spark: SparkSession, sf: str) -> DataFrame:
    info = orders.order_info(star_schema.sales_tables(spark, sf, order=77), id_sale=77)
    return info.select(
        "id_sale", "status", "client", "adress.code", "adress.city", "product", "amount"
    )


def _places(spark: SparkSession, sf: str) -> DataFrame:
    read = [star_schema.read_star(spark, sf, name) for name in ("region", "nation", "customer")]
    return star_schema.places(*read)


def _place_names(spark: SparkSession, sf: str) -> DataFrame:
    """Three levels: one recursive query."""
    return full_names(_places(spark, sf), one_job=True)


def _place_names_in_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return full_names(_places(spark, sf))


def _one_place_name(spark: SparkSession, sf: str) -> DataFrame:
    wanted = spark.createDataFrame([("c42",)], "id string")
    return full_names(_places(spark, sf), keys=wanted)


def _product_names(spark: SparkSession, sf: str) -> DataFrame:
    return full_names(star_schema.products(star_schema.read_star(spark, sf, "part")))


def _available_stock(spark: SparkSession, sf: str) -> DataFrame:
    return stock.available_stock(star_schema.stock_tables(spark, sf))


def _ready_products(spark: SparkSession, sf: str) -> DataFrame:
    return stock.products_with_stock(star_schema.stock_tables(spark, sf))


def _check_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    tables = star_schema.stock_tables(spark, sf, SOLD_BEFORE)
    return stock.check_order_lines(tables, tables["new_lines"])


def _admit_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    tables = star_schema.stock_tables(spark, sf, SOLD_BEFORE)
    return stock.admit_order_lines(tables, tables["new_lines"])


def _admit_in_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Every contested product is resolved in rounds, as very large ones are."""
    tables = star_schema.stock_tables(spark, sf, SOLD_BEFORE)
    return admit_one_by_one(tables["new_lines"], stock.available_stock(tables), task_lines=0)


def _accepted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What a strict insert takes once the refused lines are left out."""
    tables = star_schema.stock_tables(spark, sf, SOLD_BEFORE)
    checked = stock.check_order_lines(tables, tables["new_lines"])
    return require_accepted(checked.where("ok"))


def _stream_in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Lines arrive in four parts, in the order of their ids; what is left is keyed state."""
    lineitem = star_schema.read_star(spark, sf, "lineitem")
    lots = star_schema.stock_lots(lineitem)
    ready = (
        lots.where("ready_to_sale").groupBy("id_flower").agg(F.sum("amount").alias("available"))
    )
    lines = star_schema.order_lines(lineitem)
    folder = _new_folder(spark)
    last = lineitem.agg(F.max("l_orderkey").alias("k")).first()["k"] or 0
    for part in range(4):
        low, high = last * part // 4, last * (part + 1) // 4
        here = F.col("id_sale").between(low + (part > 0), high)
        # Lines without an order come first.
        arrived = lines.where(here | F.col("id_sale").isNull() if part == 0 else here)
        arrived.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(lines.schema).parquet(f"{folder}/in")
        writer = keyed_admission_stream(arriving, ready, f"{folder}/out", f"{folder}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
    schema = "id bigint, id_sale bigint, id_flower bigint, amount int, accepted boolean"
    return spark.read.schema(schema).parquet(f"{folder}/out")


def _on_sql_surface(statement: str) -> Query:
    """A statement that calls the SQL functions over the stored wide tables."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        register_sql_surface(spark, star_schema.sales_tables(spark, sf), AS_OF)
        return spark.sql(statement)

    return run


def _sql_increment(spark: SparkSession, sf: str) -> DataFrame:
    star_schema.read_star(spark, sf, "part").createOrReplaceTempView("part")
    register_sql_functions(spark, ["increment"])
    return spark.sql("SELECT p_partkey, increment(p_size) AS next_size FROM part")


def _stream_admission(spark: SparkSession, sf: str) -> DataFrame:
    """All lines arrive as a file stream and meet the ready lots of their products."""
    lots = star_schema.stock_lots(star_schema.read_star(spark, sf, "lineitem"))
    ready = (
        lots.where("ready_to_sale").groupBy("id_flower").agg(F.sum("amount").alias("available"))
    )
    arriving = (
        spark.readStream.schema(star_schema.SCHEMAS["lineitem"])
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(sf)
    )
    folder = _new_folder(spark)
    writer = admission_stream(
        arriving, ready, f"{folder}/out", f"{folder}/state", prepare=star_schema.order_lines
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    schema = "id bigint, id_sale bigint, id_flower bigint, amount int"
    return decided_lines(spark, f"{folder}/out", schema).drop("batch")


def _increment_values(spark: SparkSession, sf: str) -> DataFrame:
    part = star_schema.read_star(spark, sf, "part")
    return part.select("p_partkey", increment(F.col("p_size")).alias("next_size"))


def _decode_address(spark: SparkSession, sf: str) -> DataFrame:
    customer = star_schema.read_star(spark, sf, "customer")
    text = F.expr(
        "concat('(', c_nationkey, ',', c_mktsegment, ',\"', c_name, ', ', c_custkey, '\",)')"
    )
    return customer.select("c_custkey", decoders.decode_address(text).alias("a")).select(
        "c_custkey", "a.code", "a.city", "a.street", "a.phone_number"
    )


def _decode_money(spark: SparkSession, sf: str) -> DataFrame:
    customer = star_schema.read_star(spark, sf, "customer")
    plain = F.col("c_acctbal").cast("decimal(19,2)").cast("string")
    grouped = F.regexp_replace(F.replace(plain, F.lit("."), F.lit(",")), r"(\d)(\d{3},)", "$1 $2")
    text = F.concat(grouped, F.lit(" ?"))
    return customer.select("c_custkey", decoders.decode_money(text).alias("balance"))


def _decode_binary(spark: SparkSession, sf: str) -> DataFrame:
    customer = star_schema.read_star(spark, sf, "customer")
    text = F.concat(F.lit("\\x"), F.lower(F.hex("c_name")))
    return customer.select(
        "c_custkey", decoders.decode_binary(text).cast("string").alias("decoded")
    )


def _rule_counts(rules: Callable, *names: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tables = star_schema.flawed_tables(spark, sf)
        counted = [
            quality.count_row_violations(tables[name], name, rules(CATALOG[name])) for name in names
        ]
        return reduce(DataFrame.unionByName, counted)

    return run


def _email_rows(spark: SparkSession, sf: str) -> DataFrame:
    user = star_schema.flawed_tables(spark, sf)["user"]
    broken = quality.row_violations(user, quality.email_rules(CATALOG["user"]))
    return broken.select("id", "e_mail", "rule")


def _judged(spark: SparkSession, sf: str, kind: str, *names: str) -> DataFrame:
    tables = star_schema.flawed_tables(spark, sf)
    rules = [r for name in names for r in quality.declared_rules(CATALOG[name]) if r.name.startswith(kind)]
    return quality.judge({name: tables[name] for name in names}, rules)


def _primary_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf, "primary_key:", "sale_detail", "sale_flower")


def _repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = star_schema.flawed_tables(spark, sf)["sale_detail"]
    return quality.repeated_keys(lines, CATALOG["sale_detail"].key)


def _unique(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf, "unique:", "user", "flower")


def _foreign_keys(spark: SparkSession, sf: str) -> DataFrame:
    tables = star_schema.flawed_tables(spark, sf)
    return quality.count_orphans(tables, ("flower", "sale", "sale_detail"))


def _orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    tables = star_schema.flawed_tables(spark, sf)
    reference = next(r for r in CATALOG["sale_detail"].references if r.parent == "flower")
    return quality.orphan_rows(tables["sale_detail"], reference, tables["flower"])


def _quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(star_schema.flawed_tables(spark, sf), AS_OF)


def _quality_report_every_table(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(star_schema.every_flawed_table(spark, sf), AS_OF)


def _left_out(tables: dict[str, DataFrame]) -> set[str]:
    """Tables of the catalog that the star schema has no rows for."""
    return set(CATALOG) - set(tables)


def _deletion(spark: SparkSession, sf: str) -> cascade.Deletion:
    tables = star_schema.sales_tables(spark, sf)
    red = tables["flower"].where("name LIKE 'red %'")
    return cascade.plan_deletion(tables, "flower", red.select("id"), _left_out(tables))


def _deleted_lots(spark: SparkSession, sf: str) -> DataFrame:
    """Lots as the root: their bridge rows go, everything else stays."""
    tables = star_schema.sales_tables(spark, sf)
    lots = tables["flower_warehouse"].where("id_greenhouse = 3")
    plan = cascade.plan_deletion(tables, "flower_warehouse", lots.select("id"), _left_out(tables))
    return plan.apply()["sale_flower"]


def _cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _deletion(spark, sf).kept["sale_flower"]


def _deleted_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _deletion(spark, sf).doomed["sale_detail"]


def _delete_blockers(spark: SparkSession, sf: str) -> DataFrame:
    return _deletion(spark, sf).blockers


def _key_change(spark: SparkSession, sf: str) -> cascade.KeyChange:
    tables = star_schema.sales_tables(spark, sf)
    blue = tables["flower"].where("name LIKE 'blue %'")
    changes = blue.selectExpr("id", "id + 1000000000")
    return cascade.change_keys(tables, "flower", changes, _left_out(tables))


def _key_change_blockers(spark: SparkSession, sf: str) -> DataFrame:
    """Changes that collide: every product moves to the next number, some twice."""
    tables = star_schema.sales_tables(spark, sf)
    part = tables["flower"].where("id % 10 = 0")
    changes = part.selectExpr("id", "id + 1").union(
        part.where("id % 50 = 0").selectExpr("id", "id + 2000000000")
    )
    return cascade.change_keys(tables, "flower", changes, _left_out(tables)).blockers


def _changed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _key_change(spark, sf).tables["sale_detail"]


def _changed_products(spark: SparkSession, sf: str) -> DataFrame:
    return _key_change(spark, sf).tables["flower"]


def _assign_ids(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = star_schema.read_star(spark, sf, "lineitem")
    return assign_ids(lineitem, lineitem.columns, start=1000)


def _fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    sale = star_schema.sales(star_schema.read_star(spark, sf, "orders"))
    return fill_defaults(sale.drop("buy_date", "status"), CATALOG["sale"], AS_OF)


def _append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Old orders are saved whole; the others are appended without a status."""
    folder = _new_folder(spark)
    sale = star_schema.sales(star_schema.read_star(spark, sf, "orders"))
    store.save_table(sale.where("buy_date < DATE'1998-01-01'"), folder, "sale", wide=True)
    rest = sale.where("buy_date >= DATE'1998-01-01'").drop("status")
    store.append_rows(rest, folder, "sale", AS_OF, wide=True)
    return store.load_snapshot(spark, folder, ["sale"], wide=True)["sale"]


def _snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = _new_folder(spark)
    tables = star_schema.sales_tables(spark, sf)
    names = list(tables)
    store.save_snapshot(tables, folder, wide=True)
    loaded = store.load_snapshot(spark, folder, names, wide=True)
    return reduce(DataFrame.unionByName, [_fingerprint(name, loaded[name]) for name in names])


def _fingerprint(name: str, df: DataFrame) -> DataFrame:
    """Rows and an order-free hash over every column of a table."""
    plain = []
    for field in df.schema.fields:
        parts = field.dataType.names if field.dataType.typeName() == "struct" else []
        plain += [F.col(f"{field.name}.{part}") for part in parts] or [F.col(field.name)]
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in plain])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum(number).alias("fingerprint"),
    )


def _restored_report(spark: SparkSession, sf: str) -> DataFrame:
    """The rules judged on a snapshot after its checked reload, as a dump is checked after its rows."""
    folder = _new_folder(spark)
    store.save_snapshot(star_schema.sales_tables(spark, sf), folder, wide=True)
    return store.restore(spark, folder, AS_OF, wide=True)[1]


def _numbered_append(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without a number are appended and get numbers above all that are stored."""
    folder = _new_folder(spark)
    sale = star_schema.sales(star_schema.read_star(spark, sf, "orders"))
    store.save_table(sale, folder, "sale", wide=True)
    new = sale.where("buy_date >= DATE'2001-01-01'").drop("id")
    store.append_rows(new, folder, "sale", AS_OF, wide=True)
    return store.load_snapshot(spark, folder, ["sale"], wide=True)["sale"]


def _stock_from_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Lines are stored in two parts; the totals of the first are carried on by the second."""
    folder = _new_folder(spark)
    tables = star_schema.stock_tables(spark, sf)
    lines, dated = tables["sale_detail"], {"sale": tables["sale"]}
    old = F.col("id_sale") % 2 == 0
    store.save_table(lines.where(old), folder, "sale_detail", wide=True, tables=dated)
    totals.refresh_totals(spark, folder, wide=True)
    store.append_rows(lines.where(~old), folder, "sale_detail", AS_OF, wide=True, tables=dated)
    totals.refresh_totals(spark, folder, wide=True)
    return stock.available_stock(tables, sold_units=totals.sold_units(spark, folder))


def _stored_order_cost(spark: SparkSession, sf: str) -> DataFrame:
    """One order of a store: its rows are found by the order of the files and their bloom filters."""
    folder = _new_folder(spark)
    store.save_snapshot(star_schema.sales_tables(spark, sf), folder, wide=True)
    return orders.order_cost(store.load_tables(spark, folder, _SOLD, wide=True), 77)


def _materialised_sum(spark: SparkSession, sf: str) -> DataFrame:
    folder = _new_folder(spark)
    lines = star_schema.order_lines(star_schema.read_star(spark, sf, "lineitem"))
    store.save_total(lines, "amount", folder)
    return store.load_table(spark, folder, "sale_sum")


def queries() -> dict[str, Query]:
    added = training_data.queries() if training_data else {}
    return {
        "product_sales_last_year": _of_sales(sales.product_sales_last_year, YEAR, as_of=AS_OF),
        "product_sales_calendar_year": _of_sales(
            sales.product_sales_last_year, CALENDAR, as_of=AS_OF, calendar=True, dedupe_lots=True
        ),
        "product_sales_ranked": _of_sales(sales.product_sales_ranked, YEAR, as_of=AS_OF),
        "least_sold_products": _of_sales(sales.least_sold_products, YEAR, as_of=AS_OF),
        "best_selling_products": _of_sales(sales.best_selling_products, YEAR, as_of=AS_OF),
        "unsold_products_last_month": _of_sales(sales.unsold_products_last_month, MONTH, as_of=AS_OF),
        "revenue_by_month": _of_sales(sales.revenue_by_month, YEAR, as_of=AS_OF),
        "revenue_running_total": _of_sales(sales.revenue_running_total, YEAR, as_of=AS_OF),
        "order_info": _flat_order_info,
        "order_info_one": _one_order,
        "order_cost": _of_sales(orders.order_cost),
        "order_cost_one": _of_order(orders.order_cost, 77),
        "order_unit_cost_sum": _of_sales(orders.order_unit_cost_sum),
        "treatment_counts": _of_greenhouses(greenhouses.treatment_counts, as_of=TREATED_AS_OF),
        "untreated_lots": _of_greenhouses(greenhouses.untreated_lots, as_of=TREATED_AS_OF),
        "full_names": _place_names,
        "full_names_rounds": _place_names_in_rounds,
        "full_name_one": _one_place_name,
        "product_full_names": _product_names,
        "available_stock": _available_stock,
        "products_with_stock": _ready_products,
        "check_order_lines": _check_order_lines,
        "admit_order_lines_sequential": _admit_order_lines,
        "stream_admission": _stream_admission,
        "admit_order_lines_rounds": _admit_in_rounds,
        "accepted_order_lines": _accepted_lines,
        "stream_admission_batches": _stream_in_batches,
        "sql_increment": _sql_increment,
        "sql_cost": _on_sql_surface(
            "SELECT id AS id_sale, cost(id) AS cost FROM sale"
        ),
        "sql_sale_cost": _on_sql_surface(
            "SELECT id AS id_sale, sale_cost(id) AS cost FROM sale"
        ),
        "sql_full_name": _on_sql_surface("SELECT id, full_name(id) AS fullname FROM flower"),
        "sql_sale_info": _on_sql_surface(
            "SELECT s.id AS id_sale, i.`Статус заказа` AS status, i.`ФИО клиента` AS client,"
            " i.`Адресс доставки`.city AS city, i.`Цветок` AS product, i.`Количество` AS amount"
            " FROM sale s, LATERAL sale_info(s.id) i"
        ),
        "sql_running_revenue": _on_sql_surface("SELECT month, sum FROM sum_for_year"),
        "increment_values": _increment_values,
        "decode_address": _decode_address,
        "decode_money": _decode_money,
        "decode_binary": _decode_binary,
        "dq_not_null": _rule_counts(quality.null_rules, "user", "sale_detail"),
        "dq_check": _rule_counts(
            quality.check_rules, "flower", "sale", "sale_detail", "sale_flower"
        ),
        "dq_email": _email_rows,
        "dq_enum": _rule_counts(quality.enum_rules, "sale"),
        "dq_length": _rule_counts(quality.length_rules, "user", "flower"),
        "dq_primary_key": _primary_keys,
        "dq_repeated_lines": _repeated_lines,
        "dq_unique": _unique,
        "dq_foreign_key": _foreign_keys,
        "dq_orphan_lines": _orphan_lines,
        "quality_report": _quality_report,
        "quality_report_every_table": _quality_report_every_table,
        "cascade_delete": _cascade_delete,
        "cascade_deleted_lines": _deleted_lines,
        "cascade_blockers": _delete_blockers,
        "cascade_delete_lots": _deleted_lots,
        "cascade_update_blockers": _key_change_blockers,
        "cascade_update_keys": _changed_lines,
        "cascade_update_self": _changed_products,
        "assign_ids": _assign_ids,
        "fill_defaults": _fill_defaults,
        "append_roundtrip": _append_roundtrip,
        "snapshot_roundtrip": _snapshot_roundtrip,
        "materialised_sum": _materialised_sum,
        "restored_report": _restored_report,
        "numbered_append": _numbered_append,
        "stock_from_totals": _stock_from_totals,
        "stored_order_cost_one": _stored_order_cost,
        **added,
    }


def oracle_sql() -> dict[str, str]:
    added = training_data.oracle_sql() if training_data else {}
    return {**oracles.statements(), **added}
