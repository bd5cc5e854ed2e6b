from __future__ import annotations

import tempfile
from decimal import Decimal

import plain_reports as plain
import pytest
from nursery_rows import AS_OF
from test_admission import draw_lines, one_by_one

from verdure.functions.sql_surface import register_sql_functions, register_sql_surface
from verdure.streaming.admission_stream import (
    STATE_GROUPS,
    admission_stream,
    admit_batch,
    decided_lines,
    keyed_admission_stream,
)

LINE = "id bigint, id_flower int, amount int, note string"


def decisions(spark, folder):
    return {r.id: r.accepted for r in decided_lines(spark, folder, LINE).collect()}


def test_batches_share_the_stock(spark):
    folder = tempfile.mkdtemp(prefix="verdure-test-")
    lines = draw_lines(21, 120, 4, 9)
    stock = {0: 100, 1: 40, 2: 60}
    for number in range(3):
        part = spark.createDataFrame(lines[number * 40 : number * 40 + 40], LINE)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    available = spark.createDataFrame(list(stock.items()), "id_flower int, available bigint")
    arriving = spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")

    def run():
        writer = admission_stream(arriving, available, f"{folder}/out", f"{folder}/state")
        writer.trigger(availableNow=True).start().awaitTermination()

    run()
    expected = one_by_one(lines, stock)
    assert decisions(spark, f"{folder}/out") == expected
    # A later run goes on with what is left.
    late = [(1000 + i, p, 1, f"line {1000 + i}") for i, p in enumerate([0, 1, 2, 3] * 5)]
    spark.createDataFrame(late, LINE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()
    assert decisions(spark, f"{folder}/out") == one_by_one(lines + late, stock)


def test_a_repeated_batch_counts_once(spark):
    folder = tempfile.mkdtemp(prefix="verdure-test-")
    available = spark.createDataFrame([(0, 10)], "id_flower int, available bigint")
    decide = admit_batch(available, folder)
    first = spark.createDataFrame([(1, 0, 6, "a")], LINE)
    second = spark.createDataFrame([(2, 0, 4, "b"), (3, 0, 1, "c")], LINE)
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        decide(batch, number)
    assert decisions(spark, folder) == {1: True, 2: True, 3: False}


def test_a_repeated_batch_replaces_its_outcome(spark):
    folder = tempfile.mkdtemp(prefix="verdure-test-")
    lines = spark.createDataFrame([(1, 0, 6, "a")], LINE)
    for units, accepted in ((10, True), (2, False)):
        available = spark.createDataFrame([(0, units)], "id_flower int, available bigint")
        admit_batch(available, folder)(lines, 0)
        assert decisions(spark, folder) == {1: accepted}


def test_empty_batch(spark):
    folder = tempfile.mkdtemp(prefix="verdure-test-")
    available = spark.createDataFrame([(0, 10)], "id_flower int, available bigint")
    decide = admit_batch(available, folder)
    decide(spark.createDataFrame([], LINE), 0)
    decide(spark.createDataFrame([(1, 0, 6, "a")], LINE), 1)
    assert decisions(spark, folder) == {1: True}


@pytest.fixture
def file_stream(spark):
    """Lines arrive as files, one per micro-batch."""
    folder = tempfile.mkdtemp(prefix="verdure-test-")

    def add(lines):
        spark.createDataFrame(lines, LINE).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run(available):
        arriving = spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        writer = keyed_admission_stream(arriving, available, f"{folder}/out", f"{folder}/state")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.read.schema(f"{LINE}, accepted boolean").parquet(f"{folder}/out").collect()
        assert all(r.note == f"line {r.id}" for r in found)
        return {r.id: r.accepted for r in found}, query

    return add, run


def test_keyed_state_carries_what_is_left(spark, file_stream):
    add, run = file_stream
    lines = draw_lines(21, 120, 4, 9)
    stock = {0: 100, 1: 40, 2: 60}
    available = spark.createDataFrame(list(stock.items()), "id_flower int, available bigint")
    for number in range(4):
        add(lines[number * 30 : number * 30 + 30])
    found, query = run(available)
    assert found == one_by_one(lines, stock)
    # The state holds one row per product, and a batch rewrites those of its own lines.
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(rows) <= 8
    late = [(1000 + i, p, 1, f"line {1000 + i}") for i, p in enumerate([0, 1, 2, 3] * 5)]
    add(late)
    assert run(available)[0] == one_by_one(lines + late, stock)
    touched = [(2000, 1, 1, "line 2000")]
    add(touched)
    _, query = run(available)
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]]
    assert max(updated) <= 1


def test_keyed_state_with_awkward_lines(spark, file_stream):
    add, run = file_stream
    add([(1, 0, None, "line 1"), (2, 0, -5, "line 2"), (3, None, 1, "line 3"), (4, 0, 4, "line 4"), (5, 0, 4, "line 5"), (6, 9, 1, "line 6")])
    available = spark.createDataFrame([(0, 3), (0, 2), (7, 1)], "id_flower int, available bigint")
    assert run(available)[0] == {1: False, 2: False, 3: False, 4: True, 5: False, 6: False}


def test_keyed_state_is_kept_by_groups_of_products(spark):
    """More products than groups, with numbers that a float cannot hold, and NULLs among them."""
    folder, line = tempfile.mkdtemp(prefix="verdure-test-"), "id bigint, id_flower bigint, amount int, note bigint"
    numbers = [*((1 << 60) + i for i in range(STATE_GROUPS + 900)), None]
    available = spark.createDataFrame([(n, 5) for n in numbers if n], "id_flower bigint, available bigint")

    def run(lines):
        rows = spark.createDataFrame(lines, line)
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(line).parquet(f"{folder}/in")
        writer = keyed_admission_stream(arriving, available, f"{folder}/out", f"{folder}/state")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.read.schema(f"{line}, accepted boolean").parquet(f"{folder}/out").collect()
        rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return {(r.id, r.id_flower, r.note): r.accepted for r in found}, max(rows)

    def lines(first):
        odd = lambda i: None if i % 3 else (1 << 61) + i
        return [(2 * i + first, n, 3, odd(i)) for i, n in enumerate(numbers)]

    expected = {(i, n, x): n is not None for i, n, _, x in lines(0)}
    found, rows = run(lines(0))
    assert found == expected
    assert rows <= STATE_GROUPS
    found, _ = run([(i, n, 2 + i % 4 // 2, x) for i, n, _, x in lines(1)])
    assert found == expected | {(i, n, x): n is not None and i % 4 < 2 for i, n, _, x in lines(1)}


@pytest.fixture(scope="module")
def surface(spark, nursery):
    register_sql_surface(spark, nursery, AS_OF)
    return spark


def test_views(surface):
    sold = {r.flower: r.sum_amount for r in surface.sql("SELECT * FROM flower_sum").collect()}
    assert sold == plain.units_sold(plain.YEAR)
    expected = plain.revenue(plain.YEAR)
    assert surface.sql("SELECT sum FROM sum_for_year ORDER BY month DESC").first()[0] == sum(expected.values())
    assert surface.sql("SELECT count(*) FROM sum_for_month").first()[0] == len(expected)


def test_scalar_functions(surface):
    row = surface.sql("SELECT increment(41), cost(70), cost(999), full_name(412), full_name(110), full_name(99)")
    expected = (42, Decimal("565.00"), None, " Broadleaf river birch birch bonsai", "", None)
    assert tuple(row.first()) == expected
    with pytest.raises(Exception, match="OVERFLOW"):
        surface.sql("SELECT increment(id) FROM VALUES (2147483647) AS t(id)").collect()


def test_unit_costs(surface):
    assert tuple(surface.sql("SELECT sale_cost(70), sale_cost(86)").first()) == (Decimal("415.00"), None)


def test_functions_over_a_table(surface):
    rows = surface.sql("SELECT id, full_name(id) AS n FROM flower").collect()
    assert {r.id: r.n for r in rows} == {i: plain.full_name(i) for i in plain.NAMES}


def test_registering_runs_nothing(spark, nursery):
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None), default=-1)
    register_sql_surface(spark, nursery, AS_OF)
    assert max(tracker.getJobIdsForGroup(None), default=-1) == before


def test_table_function(surface):
    rows = surface.sql("SELECT * FROM sale_info(74)")
    assert rows.columns == ["Статус заказа", "ФИО клиента", "Адресс доставки", "Цветок", "Количество"]
    assert sorted((r[3], r[4]) for r in rows.collect()) == [("birch bonsai", 9), ("paper birch", 2)]
    city = surface.sql("SELECT `Адресс доставки`.city FROM sale_info(74)").first()[0]
    assert city == "Harbour"


def test_increment_alone(spark):
    register_sql_functions(spark, ["increment"])
    assert spark.sql("SELECT increment(1)").first()[0] == 2
