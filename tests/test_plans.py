"""Plans: what reaches the scan, what is never planned, and how skew is split."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from verdure.operators.joins import join_by_key
from verdure.plans import orders, sales
from verdure.sources import star_schema

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "product_sales_last_year", "least_sold_products", "best_selling_products",
    "unsold_products_last_month", "revenue_by_month", "revenue_running_total", "order_info",
    "order_cost", "order_unit_cost_sum", "untreated_lots", "available_stock",
    "products_with_stock", "check_order_lines", "dq_foreign_key", "dq_orphan_lines",
    "quality_report", "cascade_delete", "cascade_blockers", "cascade_update_keys",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_or_null_aware_join(spark, name):
    plan = plan_of(driver.queries()[name](spark, FOLDER))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "LeftAnti, BuildRight, true" not in plan


@pytest.mark.parametrize("name", ["product_sales_last_year", "revenue_by_month", "unsold_products_last_month"])
def test_dates_reach_the_scan(spark, name):
    plan = plan_of(driver.queries()[name](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(driver.queries()["revenue_by_month"](spark, FOLDER))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan and "s_name" not in plan


def test_the_order_key_reaches_the_scans(spark):
    tables = star_schema.sales_tables(spark, FOLDER)
    plan = plan_of(orders.order_info(tables, 77))
    assert "EqualTo(o_orderkey,77)" in plan


@pytest.fixture
def small_limits(spark):
    """Limits scaled down so that a few megabytes behave like a large table."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_rows(spark, rows=120_000):
    """A third of the rows has key 7; several files, so that a partition can be split."""
    folder = tempfile.mkdtemp(prefix="verdure-test-")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(5000)))
    spark.range(0, rows, 1, 8).select("id", key.alias("k"), F.sha1(F.col("id").cast("string")).alias("s")).write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/t")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split_when_joined_to_a_grouped_table(spark, small_limits, how):
    rows = hot_rows(spark)
    grouped = rows.where("id % 2 = 1 OR id < 9").groupBy(F.col("k").alias("key")).agg(F.count("*").alias("n"))
    joined = join_by_key(rows, "k", grouped, "key", how)
    plain = rows.join(grouped, F.col("k") == F.col("key"), how)
    joined.write.format("noop").mode("overwrite").save()
    collected = joined.groupBy().agg(F.count("*"), F.sum("id"), F.sum(F.xxhash64(*joined.columns).cast("decimal(38,0)")))
    assert collected.collect() == plain.groupBy().agg(
        F.count("*"), F.sum("id"), F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)"))
    ).collect()
    if how != "left_anti":  # with an anti join the hot rows match and vanish
        assert spread_of(joined, "k") >= 5


def spread_of(df, key):
    """Number of tasks over which the rows of the hot key are spread."""
    # The partition number is taken first: it keeps the filter above the join.
    placed = df.select(key, F.spark_partition_id().alias("p"))
    return len({row.p for row in placed.where(F.col(key) == 7).collect()})


def test_hot_product_is_split_in_the_order_report(spark, small_limits):
    lines = hot_rows(spark).select("id", (F.col("id") % 1000).alias("id_sale"), F.col("k").alias("id_flower"), F.lit(1).alias("amount"))
    flower = spark.range(0, 5000, 1, 4).selectExpr("id", "concat('p', id) AS name")
    address = "named_struct('code', 'a', 'city', 'b', 'street', 'c', 'phone_number', 'd') AS adress"
    tables = {
        "sale": spark.range(1000).selectExpr("id", "id % 9 AS id_user", "id % 3 AS id_adress", "'sent' AS status"),
        "sale_detail": lines,
        "flower": flower,
        "user": spark.range(9).selectExpr("id", "'n' AS name", "'s' AS surname", address),
        "adress_sale": spark.range(2).selectExpr("id", address),
    }
    info = orders.order_info(tables)
    assert len(info.collect()) == 120_000
    plan = plan_of(info)
    assert "skew=true" in plan


def test_the_order_key_reaches_the_line_scan(spark):
    for name in ("order_info_one", "order_cost_one"):
        plan = plan_of(driver.queries()[name](spark, FOLDER))
        assert "EqualTo(l_orderkey,77)" in plan


def test_the_years_orders_cut_the_lines_before_they_are_grouped(spark):
    tables = star_schema.sales_tables(spark, FOLDER, as_of="2001-08-01", window="year")
    plan = tables["sale_detail"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


@pytest.mark.parametrize(("window", "calendar"), [("year", False), ("calendar year", True)])
@pytest.mark.parametrize("as_of", ["2001-08-01", "2000-02-29", "1999-01-01"])
def test_the_cut_changes_no_report(spark, window, calendar, as_of):
    whole = star_schema.sales_tables(spark, FOLDER)
    cut = star_schema.sales_tables(spark, FOLDER, as_of=as_of, window=window)
    for report in (sales.product_sales_last_year, sales.revenue_by_month):
        rows = [sorted(map(tuple, report(t, as_of, calendar=calendar).collect())) for t in (whole, cut)]
        assert rows[0] == rows[1]
    assert len(rows[0]) > 0


def test_windows_are_named():
    with pytest.raises(ValueError, match="unknown window"):
        star_schema.sales_tables(None, FOLDER, as_of="2001-08-01", window="week")


def _exchanges(plan):
    return plan.count("hashpartitioning(")


def test_the_batch_check_plans_few_shuffles(spark, small_limits):
    """The running demand is made first; what is planned up to it and after it."""
    seen = []
    plain = star_schema.stock_tables(spark, FOLDER, driver.SOLD_BEFORE)
    from verdure.operators import ranking

    def noted(df):
        seen.append(plan_of(df))
        return cut(df)

    cut, ranking.cut_lineage = ranking.cut_lineage, noted
    try:
        from verdure.plans import stock

        rest = plan_of(stock.check_order_lines(plain, plain["new_lines"]))
    finally:
        ranking.cut_lineage = cut
    assert len(seen) == 1 and "rangepartitioning" in seen[0]
    assert _exchanges(seen[0]) <= 8 and _exchanges(rest) == 0
