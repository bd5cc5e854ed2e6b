from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.operators.admission import (
    admit_one_by_one,
    check_running_demand,
    first_fit,
    require_accepted,
)

LINE = "id bigint, id_flower int, amount int, note string"


def one_by_one(lines, stock):
    left, accepted = dict(stock), {}
    for id_, product, amount, _ in sorted(lines):
        fits = amount is not None and 0 < amount <= left.get(product, 0)
        accepted[id_] = fits
        if fits:
            left[product] -= amount
    return accepted


def admitted(spark, lines, stock, **options):
    frame = spark.createDataFrame(lines, LINE).repartition(3)
    available = spark.createDataFrame(list(stock.items()), "id_flower int, available bigint")
    result = admit_one_by_one(frame, available, **options).collect()
    assert len(result) == len(lines)
    assert all(r.note == f"line {r.id}" for r in result)
    return {r.id: r.accepted for r in result}


def draw_lines(seed, count, products, largest):
    draw = random.Random(seed)
    return [
        # A third of the lines want one product.
        (i, 0 if draw.random() < 0.34 else draw.randrange(products), draw.randint(1, largest), f"line {i}")
        for i in range(count)
    ]


@pytest.mark.parametrize(
    ("seed", "largest", "supply"), [(1, 9, 100), (2, 1000, 3000), (3, 3, 40), (4, 50, 1)]
)
def test_fold_and_rounds_agree_with_a_loop(spark, seed, largest, supply):
    lines = draw_lines(seed, 300, 6, largest)
    stock = {p: random.Random(seed + p).randint(0, supply) for p in range(5)}  # product 5 has none
    expected = one_by_one(lines, stock)
    assert admitted(spark, lines, stock) == expected
    # Every contested product is resolved in rounds, with many small blocks.
    assert admitted(spark, lines, stock, task_lines=5, ranges=7) == expected


def test_rounds_on_awkward_amounts(spark):
    """A falling staircase of amounts, where each refusal is followed by a fit."""
    amounts = [x for top in range(20, 0, -1) for x in (1, top)] + [16, 8, 4, 2, 1, 1, 1]
    stock = dict(enumerate((0, 1, 2, 3, 15, 16, 17, 31, 33, 64, 1000)))
    wanted = [(product, amount) for amount in amounts for product in stock]
    lines = [(i, product, amount, f"line {i}") for i, (product, amount) in enumerate(wanted)]
    assert admitted(spark, lines, stock, task_lines=1, ranges=5) == one_by_one(lines, stock)


@pytest.mark.parametrize("seed", range(6))
def test_phases_agree_with_a_loop(seed):
    draw = random.Random(seed)
    largest = draw.choice((3, 100, 1 << 40))
    run = np.sort(np.array([draw.randrange(9) for _ in range(500)]))
    run = np.unique(run, return_inverse=True)[1]
    amount = np.array([draw.randint(-2, largest) for _ in run], dtype=np.int64)
    left = np.array([draw.randint(-5, largest * 20) for _ in range(run.max() + 1)], dtype=np.int64)
    accepted, rest = first_fit()(run, amount, left)
    stock, expected = left.tolist(), []
    for r, a in zip(run.tolist(), amount.tolist(), strict=True):
        expected.append(0 < a <= stock[r])
        stock[r] -= a if expected[-1] else 0
    assert accepted.tolist() == expected
    assert rest.tolist() == stock


def test_a_product_goes_on_over_batches(spark):
    lines = draw_lines(11, 400, 3, 9)
    stock = {0: 300, 1: 100, 2: 5}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 7)
    try:
        assert admitted(spark, lines, stock) == one_by_one(lines, stock)
        frame = spark.createDataFrame(lines, LINE)
        supply = spark.createDataFrame(list(stock.items()), "id_flower int, available bigint")
        checked = {r.id: r.available for r in check_running_demand(frame, supply).collect()}
    finally:
        spark.conf.set(size, before)
    left = dict(stock)
    for id_, product, amount, _ in sorted(lines):
        assert checked[id_] == left[product]
        left[product] -= amount


def test_admission_of_lines_without_product_and_of_none(spark):
    available = spark.createDataFrame([(0, 10), (None, 10)], "id_flower int, available bigint")
    lines = spark.createDataFrame([(1, None, 4, "a"), (2, 0, 4, "b")], LINE)
    found = {r.id: r.accepted for r in admit_one_by_one(lines, available.where("id_flower = 0")).collect()}
    assert found == {1: False, 2: True}
    empty = spark.createDataFrame([], LINE)
    assert admit_one_by_one(empty, available).collect() == []
    assert check_running_demand(empty, available).collect() == []
    assert [r.ok for r in check_running_demand(lines, available.limit(0)).collect()] == [False, False]


def test_invalid_amounts_are_refused_and_use_nothing(spark):
    lines = [(1, 0, None, "line 1"), (2, 0, -5, "line 2"), (3, 0, 0, "line 3"), (4, 0, 4, "line 4"), (5, 0, 4, "line 5")]
    for options in ({}, {"task_lines": 1}):
        assert admitted(spark, lines, {0: 5}, **options) == {1: False, 2: False, 3: False, 4: True, 5: False}


def test_negative_stock_admits_nothing(spark):
    lines = [(1, 0, 1, "line 1")]
    assert admitted(spark, lines, {0: -3}) == {1: False}


@pytest.mark.parametrize("ranges", [1, 4, 23])
def test_running_demand(spark, ranges):
    lines = draw_lines(7, 200, 5, 9)
    stock = {0: 150, 1: 60, 2: 0, 3: 500}
    frame = spark.createDataFrame(lines, LINE).repartition(3)
    available = spark.createDataFrame(list(stock.items()), "id_flower int, available bigint")
    result = {r.id: r for r in check_running_demand(frame, available, ranges).collect()}
    left = dict(stock)
    for id_, product, amount, _ in sorted(lines):
        found = left.get(product, 0)
        assert (result[id_].available, result[id_].ok) == (found, amount <= found)
        assert (result[id_].message is None) == (amount <= found)
        left[product] = found - amount
    assert len(result) == len(lines)


def test_a_line_without_amount_takes_nothing_but_does_not_pass(spark):
    lines = spark.createDataFrame([(1, 0, None, "a"), (2, 0, 5, "b")], LINE)
    available = spark.createDataFrame([(0, 5)], "id_flower int, available bigint")
    checked = check_running_demand(lines, available)
    assert {r.id: (r.available, r.ok) for r in checked.collect()} == {1: (5, None), 2: (5, True)}
    with pytest.raises(Exception):
        require_accepted(checked).collect()


def test_strict_mode(spark):
    available = spark.createDataFrame([(0, 5)], "id_flower int, available bigint")
    good = spark.createDataFrame([(1, 0, 3, "a"), (2, 0, 2, "b")], LINE)
    passed = require_accepted(check_running_demand(good, available))
    assert sorted(tuple(r) for r in passed.collect()) == [(1, 0, 3, "a"), (2, 0, 2, "b")]
    bad = spark.createDataFrame([(1, 0, 3, "a"), (2, 0, 3, "b")], LINE)
    with pytest.raises(Exception, match=r"\(3\).*\(2\)"):
        require_accepted(check_running_demand(bad, available)).collect()


@pytest.mark.parametrize("read", [lambda df: df.count(), lambda df: df.select("id").collect()])
def test_a_refused_line_fails_whatever_is_read(spark, read):
    lines = spark.createDataFrame([(1, 1, 5), (2, 1, 6)], "id bigint, id_flower int, amount int")
    supply = spark.createDataFrame([(1, 10)], "id_flower int, available bigint")
    checked = check_running_demand(lines, supply)
    with pytest.raises(Exception, match="6"):
        read(require_accepted(checked))
    assert read(require_accepted(checked.where("id = 1"))) in (1, [(1,)])
    unknown = lines.withColumn("amount", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="without an amount"):
        read(require_accepted(check_running_demand(unknown, supply)))
