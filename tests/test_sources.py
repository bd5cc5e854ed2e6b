from __future__ import annotations

import datetime as dt
import tempfile
from decimal import Decimal

import duckdb
import plain_reports as plain
import pytest
from nursery_rows import AS_OF, LINES
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.functions.periods import (
    _rolling,
    stored_last_month,
    within_last_month,
    within_last_year,
)
from verdure.plans import sales, stock
from verdure.sources import star_schema, store, totals
from verdure.sources.catalog import CATALOG, INT, LONG
from verdure.sources.decoders import decode_address, decode_binary, decode_money
from verdure.sources.lineage import checkpoint_folder, cut_lineage


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="verdure-test-")


def test_catalog_counts():
    relations = CATALOG.values()
    references = [r for relation in relations for r in relation.references]
    fields = [f for relation in relations for f in relation.fields]
    assert len(CATALOG) == 27
    assert sum(bool(r.key) for r in relations) == 26
    assert sum(len(r.unique) for r in relations) == 8
    assert sum(len(r.checks) for r in relations) == 33
    assert (len(references), sum(r.on_delete_cascade for r in references)) == (29, 20)
    assert sum(r.on_update_cascade for r in references) == 28
    assert sum(f.required for f in fields) == 87
    assert sum(f.default is not None for f in fields) == 17
    for relation in relations:
        assert set(relation.key) | set(relation.unique) <= set(relation.schema.names)
        for reference in relation.references:
            parent = CATALOG[reference.parent]
            assert parent.key == ("id",)
            assert relation.field(reference.column).type == parent.field("id").type


def test_decode_address(spark):
    texts = [
        ('(60005,Port,"Sea lane, 14",380001)', ("60005", "Port", "Sea lane, 14", "380001")),
        ('(,Port,"sth st",)', (None, "Port", "sth st", None)),
        ("(,,,)", (None, None, None, None)),
        ('(1,"a ""b"" c","x\\\\y","")', ("1", 'a "b" c', "x\\y", "")),
        ("( 1,Порт,x y ,2)", (" 1", "Порт", "x y ", "2")),
        (None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string")
    found = {r.i: r.a for r in df.select("i", decode_address(F.col("t")).alias("a")).collect()}
    for i, (_, expected) in enumerate(texts):
        assert (tuple(found[i]) if found[i] else None) == expected


def test_decode_money(spark):
    texts = ["5 000,00 ?", "400,00 ?", "-1 234 567,89", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.orderBy("i").select(decode_money(F.col("t"))).collect()
    assert [r[0] for r in found] == [Decimal("5000.00"), Decimal("400.00"), Decimal("-1234567.89"), None]


def test_decode_binary(spark):
    df = spark.createDataFrame([("\\x0030",), ("\\x",), (None,)], "t string")
    assert [r[0] for r in df.select(decode_binary(F.col("t"))).collect()] == [b"\x000", b"", None]


def moments(spark, *texts):
    rows = [(dt.datetime.fromisoformat(t),) for t in texts]
    return spark.createDataFrame(rows, T.StructType([T.StructField("at", T.TimestampNTZType())]))


def kept(df):
    return sorted(str(r["at"]) for r in df.collect())


def test_month_is_clamped_at_its_end(spark):
    rows = moments(spark, "2019-02-27T23:59:59", "2019-02-28", "2019-03-31", "2019-03-31T00:00:01")
    assert kept(within_last_month(rows, "at", "2019-03-31")) == ["2019-02-28 00:00:00", "2019-03-31 00:00:00"]


def test_year_from_a_leap_day(spark):
    rows = moments(spark, "2019-02-27T12:00:00", "2019-02-28", "2020-02-29", "2020-02-29T01:00:00")
    assert kept(within_last_year(rows, "at", dt.date(2020, 2, 29))) == [
        "2019-02-28 00:00:00",
        "2020-02-29 00:00:00",
    ]


def test_calendar_periods(spark):
    rows = moments(spark, "2018-12-31T23:59:59", "2019-01-01", "2019-12-31T23:00:00", "2020-01-01", "2020-02-01")
    assert kept(within_last_year(rows, "at", "2020-02-29", calendar=True)) == [
        "2019-01-01 00:00:00",
        "2019-12-31 23:00:00",
    ]
    assert kept(within_last_month(rows, "at", "2020-01-31", calendar=True)) == ["2020-01-01 00:00:00"]


def test_window_starts_agree_with_another_engine(spark):
    first = dt.date(2019, 1, 25)
    days = [first + dt.timedelta(days=n) for n in range(0, 800, 1) if (first + dt.timedelta(days=n)).day > 26 or n % 9 == 0]
    for months in (1, 12):
        starts = spark.range(1).select(
            *[_rolling(day, months)[0].cast("string").alias(f"c{i}") for i, day in enumerate(days)]
        )
        other = duckdb.sql(
            "SELECT " + ", ".join(f"CAST(CAST(DATE '{d}' - INTERVAL {months} MONTH AS DATE) AS VARCHAR)" for d in days)
        )
        assert tuple(starts.first()) == other.fetchall()[0]


def test_default_is_today(spark):
    rows = spark.range(1).select(F.current_date().cast("timestamp_ntz").alias("at"))
    assert within_last_month(rows, "at").count() == 1
    assert within_last_year(rows, "at").count() == 1


def test_append_fills_defaults(spark, folder):
    first = spark.createDataFrame([(1, 7, 2, 50)], "id int, id_flower int, amount int, cost int")
    first = first.withColumn("ready_to_sale", F.lit(True))
    store.append_rows(first, folder, "flower_warehouse", "2020-01-05")
    store.append_rows(first.withColumn("id", F.lit(2)), folder, "flower_warehouse", "2020-01-06")
    rows = store.load_table(spark, folder, "flower_warehouse").orderBy("id").collect()
    assert [(r.id, str(r.date), r.cost, r.id_greenhouse, r.notes) for r in rows] == [
        (1, "2020-01-05", Decimal("50.00"), 1, None),
        (2, "2020-01-06", Decimal("50.00"), 1, None),
    ]


def test_snapshot(spark, nursery, folder):
    store.save_snapshot(nursery, folder)
    loaded = store.load_snapshot(spark, folder, nursery)
    for name, df in nursery.items():
        assert loaded[name].schema == CATALOG[name].schema
        assert sorted(map(str, loaded[name].collect())) == sorted(map(str, df.collect()))


def years_read(df, table):
    files = [f for f in df.inputFiles() if f"/{table}/" in f]
    return {f.split("buy_date_year=")[1].split("/")[0] for f in files}


def test_stored_years_are_pruned(spark, nursery, folder):
    store.save_snapshot(nursery, folder)
    tables = store.load_tables(spark, folder, nursery)
    for name in ("sale", "sale_detail", "sale_flower"):
        assert years_read(tables[name], name) == {"2023", "2024"}
    result = sales.revenue_by_month(tables, AS_OF)
    assert {r.month: r["sum"] for r in result.collect()} == plain.revenue(plain.YEAR)
    plan = sales.revenue_by_month(tables, "2023-06-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [(isnull(buy_date_year") == 3
    lines = stored_last_month(tables["sale_detail"], "buy_date", AS_OF)
    assert {r.buy_date_year for r in lines.collect()} == {2024}
    assert lines.count() == sum(plain.ORDERS[line[1]].year == 2024 for line in LINES)


def test_saving_again_replaces_all_years(spark, nursery, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.save_table(nursery["sale"], folder, "sale")
        store.save_table(nursery["sale"].where("year(buy_date) = 2024"), folder, "sale")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert store.load_table(spark, folder, "sale").count() == sum(d.year == 2024 for d in plain.ORDERS.values())


def test_lines_appended_without_orders_are_still_found(spark, nursery, folder):
    store.save_snapshot({k: v for k, v in nursery.items() if k != "sale_detail"}, folder)
    early = nursery["sale_detail"].where("id < 3040")
    store.append_rows(early, folder, "sale_detail", tables={"sale": nursery["sale"]})
    store.append_rows(nursery["sale_detail"].where("id >= 3040"), folder, "sale_detail")
    tables = store.load_tables(spark, folder, nursery)
    assert years_read(tables["sale_detail"], "sale_detail") == {"2023", "2024", "__HIVE_DEFAULT_PARTITION__"}
    result = sales.product_sales_last_year(tables, AS_OF).collect()
    assert {r.flower: r.sum_amount for r in result} == plain.units_sold(plain.YEAR)
    unsold = sales.unsold_products_last_month(tables, AS_OF)
    assert sorted(r.name for r in unsold.collect()) == plain.unsold(plain.MONTH)


def test_files_without_years_are_read_whole(spark, nursery, folder):
    nursery["sale"].write.parquet(f"{folder}/sale")
    sale = store.load_table(spark, folder, "sale")
    assert within_last_year(sale, "buy_date", AS_OF).count() == sum(map(plain.YEAR, plain.ORDERS.values()))


def test_wide_keys(spark, folder):
    big = spark.createDataFrame([(1 << 40, None, "x")], "id bigint, id_parent bigint, name string")
    store.save_table(big, folder, "flower", wide=True)
    loaded = store.load_table(spark, folder, "flower", wide=True)
    assert loaded.collect() == big.collect()
    assert store.stored_schema(CATALOG["flower"])["id"].dataType == INT
    assert loaded.schema["id"].dataType == LONG


def test_stored_total(spark, nursery, folder):
    store.save_total(nursery["sale_detail"].where("false"), "amount", folder)
    assert store.load_table(spark, folder, "sale_sum").collect() == [(None,)]
    store.save_total(nursery["sale_detail"], "amount", folder)
    assert store.load_table(spark, folder, "sale_sum").collect() == [(sum(line[3] for line in LINES),)]


def test_cut_lineage_goes_through_the_checkpoint_folder(spark):
    copy = cut_lineage(spark.range(5))
    assert sorted(r.id for r in copy.collect()) == [0, 1, 2, 3, 4]
    assert all(checkpoint_folder(spark).removeprefix("file:") in f for f in copy.inputFiles())


def test_line_numbers_of_any_size_keep_their_order(spark):
    rows = [(1, 5, 2, n, 3.0) for n in (1, 7, 8, 9, 1000, (1 << 20) - 1)] + [(2, 6, 2, 1, 3.0)]
    lineitem = spark.createDataFrame(
        rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    )
    lines = star_schema.order_lines(lineitem).collect()
    assert sorted(r.id_sale for r in lines) == [1] * 6 + [2]
    assert len({r.id for r in lines}) == 7
    lots = star_schema.lots_of_lines(lineitem).collect()
    assert {r.id_sale_detail for r in lots} == {r.id for r in lines}
    beyond = lineitem.withColumn("l_linenumber", F.lit(1 << 20))
    with pytest.raises(Exception, match="no line id"):
        star_schema.order_lines(beyond).collect()


def stored_orders(spark, folder, orders_per_year=4000, years=3):
    """Orders of several years with two lines each, in a mixed order, in small row groups."""
    n = orders_per_year * years
    day = F.expr(f"make_date(2001 + cast(id % {years} AS int), 1 + cast(id % 12 AS int), 1)")
    sale = spark.range(1, n + 1).select(
        "id", F.lit(1).cast("bigint").alias("id_user"), F.lit(None).cast("bigint").alias("id_adress"),
        day.cast("timestamp_ntz").alias("buy_date"), F.lit("sent").alias("status"),
    ).orderBy(F.xxhash64("id"))
    lines = spark.range(2, 2 * n + 2).select(
        "id", F.floor(F.col("id") / 2).cast("bigint").alias("id_sale"), (F.col("id") % 50).alias("id_flower"),
        F.lit(3).alias("amount"),
    ).orderBy(F.xxhash64("id"))
    tables = {"sale": sale, "sale_detail": lines}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "16384")
    conf.set("parquet.block.size.row.check.min", "64")
    conf.set("parquet.page.size.row.check.min", "64")
    try:
        for name, df in tables.items():
            store.save_table(df, folder, name, wide=True, tables=tables)
    finally:
        for key in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
            conf.unset(key)
    return n


def rows_read(df):
    """Rows that the scans of a plan handed on, after row groups were skipped."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if "QueryStageExec" in node.getClass().getSimpleName():
            walk(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_one_order_reads_few_rows(spark, folder):
    n = stored_orders(spark, folder)
    tables = store.load_tables(spark, folder, ("sale", "sale_detail"), wide=True)
    for name, column in (("sale", "id"), ("sale_detail", "id_sale")):
        read = rows_read(tables[name].where(F.col(column) == 777))
        assert 0 < sum(read) < 0.1 * n


def test_bloom_filters_rule_out_absent_orders(spark, folder):
    """Only even orders are there, so ranges do not rule an odd one out."""
    orders = spark.range(2, 8002, 2).select(
        "id", F.lit(1).cast("bigint").alias("id_user"), F.lit(None).cast("bigint").alias("id_adress"),
        F.lit("2001-05-05").cast("timestamp_ntz").alias("buy_date"), F.lit("sent").alias("status"),
    )
    store.save_table(orders, folder, "sale", wide=True)
    sale = store.load_table(spark, folder, "sale", wide=True)
    assert sum(rows_read(sale.where("id = 4001"))) == 0
    assert sum(rows_read(sale.where("id = 4002"))) > 0


def test_restore_checks_the_snapshot(spark, nursery, folder):
    store.save_snapshot(nursery, folder)
    loaded, report = store.restore(spark, folder, AS_OF)
    assert {n: df.count() for n, df in loaded.items()} == {n: df.count() for n, df in nursery.items()}
    found = {(r.table_name, r.rule): r.violations for r in report.collect()}
    # What is broken is told, as after a reload of the dump; unknown parents are not judged.
    assert found["sale", "check:id_user > 0 AND id_adress > 0"] == 0
    assert found["greenhouse", "foreign_key:id_staff->staff"] is None
    assert found["flower_warehouse", "foreign_key:id_greenhouse->greenhouse"] == 0


@pytest.mark.parametrize("damage", ["file", "value", "table", "row"])
def test_a_damaged_snapshot_is_refused(spark, nursery, folder, damage):
    import pathlib
    import shutil

    store.save_snapshot(nursery, folder)
    lines = nursery["sale_detail"]
    if damage == "file":
        next(pathlib.Path(folder, "sale_flower").rglob("part-*.parquet")).unlink()
    elif damage == "table":
        shutil.rmtree(f"{folder}/flower")
    elif damage == "row":
        store.append_rows(lines.limit(1), folder, "sale_detail", AS_OF, tables=nursery)
    else:
        other = lines.withColumn("amount", F.when(F.col("id") == 3000, 5).otherwise(F.col("amount")))
        store.save_table(other, folder, "sale_detail", tables=nursery)
    with pytest.raises(ValueError, match="missing|not as it was saved") as refused:
        store.restore(spark, folder, AS_OF)
    assert {"file": "sale_flower", "table": "flower", "row": "sale_detail.id", "value": "sale_detail.amount"}[damage] in str(refused.value)


def test_fingerprints_do_not_depend_on_the_order(spark, nursery):
    for name in ("user", "sale"):
        prints = [
            sorted(map(tuple, store.fingerprints(df, name).collect()))
            for df in (nursery[name], nursery[name].orderBy(F.desc("id")).repartition(5))
        ]
        assert prints[0] == prints[1]
    assert store.fingerprints(nursery["sale"].limit(0), "sale").count() == 5


def test_appended_rows_are_numbered_above_all_stored(spark, nursery, folder):
    store.save_table(nursery["sale_detail"], folder, "sale_detail", tables=nursery)
    new = spark.createDataFrame([(95, 314, 2), (95, 314, 1), (93, 411, 7)], "id_sale int, id_flower int, amount int")
    store.append_rows(new, folder, "sale_detail", AS_OF, tables=nursery)
    store.append_rows(new.limit(1), folder, "sale_detail", AS_OF, tables=nursery)
    rows = {r.id: r for r in store.load_table(spark, folder, "sale_detail").collect()}
    assert len(rows) == len(LINES) + 4
    assert [(i, rows[i].id_sale, rows[i].amount) for i in (3076, 3077, 3078)] == [(3076, 93, 7), (3077, 95, 1), (3078, 95, 2)]
    assert 3079 in rows


def test_rows_of_a_new_table_are_numbered_from_one(spark, folder):
    store.append_rows(spark.createDataFrame([("rust",), ("blight",)], "name string"), folder, "disease")
    rows = store.load_table(spark, folder, "disease").collect()
    assert {r.id: r.name for r in rows} == {1: "blight", 2: "rust"}


def test_the_largest_id_comes_from_the_footers(spark, nursery, folder):
    store.save_table(nursery["sale"], folder, "sale")
    assert store.largest_stored_id(spark, folder, "sale") == 99
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = store._largest_id(session, folder, "sale", False)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    store.save_table(nursery["sale"].limit(0), folder, "sale")
    assert store.largest_stored_id(spark, folder, "sale") is None


def _available(df):
    return {r.id_flower: r.available for r in df.collect()}


def test_totals_read_only_what_was_appended(spark, nursery, folder):
    early = nursery["sale_detail"].where("id < 3050")
    store.save_snapshot({**nursery, "sale_detail": early}, folder)
    first = totals.refresh_totals(spark, folder)
    assert first.version == 1 and len(first.files_read) > 0
    assert totals.refresh_totals(spark, folder).files_read == ()
    store.append_rows(nursery["sale_detail"].where("id >= 3050"), folder, "sale_detail", tables=nursery)
    second = totals.refresh_totals(spark, folder)
    assert second.version == 2 and not set(first.files_read) & set(second.files_read)
    tables = store.load_tables(spark, folder, nursery)
    sold = totals.sold_units(spark, folder)
    assert _available(stock.available_stock(tables, sold_units=sold)) == plain.stock()
    plan = stock.available_stock(tables, sold_units=sold)._jdf.queryExecution().optimizedPlan().toString()
    assert "id_sale" not in plan
    old = {r.id_flower: r.units for r in totals.sold_units(spark, folder, 1).groupBy("id_flower").agg(F.sum("units").alias("units")).collect()}
    assert old[411] == 4 + 6 + 3
    years = {(r.id_flower, r.year): r.units for r in sold.collect()}
    assert years[411, 2023] == 10 and years[411, 2024] == 11


def test_totals_follow_a_table_that_is_saved_again(spark, nursery, folder):
    store.save_snapshot(nursery, folder)
    totals.refresh_totals(spark, folder)
    store.save_table(nursery["sale_detail"].where("id <> 3000"), folder, "sale_detail", tables=nursery)
    assert totals.refresh_totals(spark, folder).version == 2
    tables = store.load_tables(spark, folder, nursery)
    found = _available(stock.available_stock(tables, sold_units=totals.sold_units(spark, folder)))
    assert found[411] == plain.stock()[411] + 4
    with pytest.raises(ValueError, match="no such version"):
        totals.sold_units(spark, folder, 7)


def test_many_parts_become_one(spark, nursery, folder, monkeypatch):
    monkeypatch.setattr(totals, "MOST_PARTS", 2)
    for k, (line, *_rest) in enumerate(LINES):
        store.append_rows(nursery["sale_detail"].where(F.col("id") == line), folder, "sale_detail", tables=nursery)
        if k % 4 == 3:
            done = totals.refresh_totals(spark, folder)
    assert len(done.parts) <= 2
    found = totals.sold_units(spark, folder).groupBy("id_flower").agg(F.sum("units").alias("n")).collect()
    assert sum(r.n for r in found) == sum(line[3] for line in LINES)


def test_snapshot_dates_tables_from_their_stored_owners(spark, folder, monkeypatch):
    """Each dated table is planned once, its owners before it; lines without an order have no year."""
    rows = {
        "sale_flower": [(10, 7, 2), (20, 7, 1), (30, 8, 1), (99, 7, 1)],
        "sale_detail": [(10, 1, 5, 2), (20, 2, 5, 1), (30, 9, 5, 1)],
        "sale": [(1, 1, 1, dt.datetime(2001, 5, 1), "sent"), (2, 1, None, dt.datetime(1999, 1, 1), "sent")],
    }
    tables = {name: spark.createDataFrame(some, CATALOG[name].schema) for name, some in rows.items()}
    dated, with_year = [], store._with_year

    def seen(df, relation, *others):
        dated.append(relation.name)
        return with_year(df, relation, *others)

    monkeypatch.setattr(store, "_with_year", seen)
    store.save_snapshot(tables, folder)
    assert dated == ["sale", "sale_detail", "sale_flower"]
    bridge = store.load_table(spark, folder, "sale_flower")
    year = next(c for c in bridge.columns if c not in CATALOG["sale_flower"].schema.names)
    years = {r.id_sale_detail: r[year] for r in bridge.collect()}
    assert years == {10: 2001, 20: 1999, 30: None, 99: None}
    loaded, _ = store.restore(spark, folder)
    assert {name: sorted(map(tuple, df.collect()), key=str) for name, df in loaded.items()} == {
        name: sorted(some, key=str) for name, some in rows.items()
    }
