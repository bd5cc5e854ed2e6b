from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from verdure.functions.columns import increment
from verdure.operators.hierarchy import ancestry, full_names
from verdure.operators.identity import assign_ids, dense_ranks, fill_defaults, next_id
from verdure.operators.joins import lookup_total, not_in
from verdure.operators.ranking import extreme_rows, running_total
from verdure.sources.catalog import CATALOG
from verdure.sources.lineage import cut_lineage


@pytest.mark.parametrize(
    ("candidates", "expected"),
    [([], [None, 1, 3]), ([1], [3]), ([1, 1, 1], [3]), ([None], []), ([1, None], []), ([7], [1, 3])],
)
def test_not_in(spark, candidates, expected):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    values = spark.createDataFrame([(c,) for c in candidates], "b int")
    kept = [r.a for r in not_in(rows, "a", values).collect()]
    assert sorted(kept, key=lambda v: (v is not None, v)) == expected
    rows.createOrReplaceTempView("left_rows")
    values.createOrReplaceTempView("right_rows")
    sql = spark.sql("SELECT a FROM left_rows WHERE a NOT IN (SELECT b FROM right_rows)")
    assert sorted(map(str, kept)) == sorted(str(r.a) for r in sql.collect())


def test_not_in_takes_one_column(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError, match="one column"):
        not_in(rows, "id", rows.selectExpr("id", "id AS b"))


def test_lookup_total(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    facts = spark.createDataFrame([(1, 5), (1, 6), (9, 1)], "f int, v int")
    result = {r.k: r.total for r in lookup_total(rows, "k", facts, "f", "v", "total").collect()}
    assert result == {1: 11, 2: 0, None: 0}


def test_extreme_rows_keeps_ties(spark):
    rows = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, v int")
    assert {r.id % 3 for r in extreme_rows(rows, "v", True).collect()} == {2}
    assert extreme_rows(rows, "v", False).count() == 10


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_running_total(spark, ranges):
    draw = random.Random(ranges)
    # One key owns a third of the rows; the order numbers may be negative.
    rows = [(i - 150, 0 if draw.random() < 0.33 else draw.randrange(8), draw.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq bigint, k int, v int").repartition(5)
    result = {r.seq: r.s for r in running_total(df, "k", "seq", "v", "s", ranges=ranges).collect()}
    sums, expected = {}, {}
    for seq, key, value in sorted(rows):
        sums[key] = sums.get(key, 0) + value
        expected[seq] = sums[key]
    assert result == expected


def test_running_total_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 1, 6)], "seq int, k int, v int")
    assert running_total(df, "k", "seq", "v", "s").count() == 2


def test_running_total_with_text_keys_opening_and_hot_key(spark):
    rows = [(i, "hot" if i % 5 else f"k{i % 35}", 1 if i % 7 else None, "x") for i in range(500)]
    rows += [(1000 + i, None, 2, "y") for i in range(20)]
    df = spark.createDataFrame(rows, "seq int, k string, v int, other string").repartition(4)
    opening = spark.createDataFrame([("hot", 1000), ("k0", -3), ("nowhere", 5)], "k string, v bigint")
    found = running_total(df, "k", "seq", "v", "s", opening, ranges=25)
    assert found.columns == [*df.columns, "s"]
    sums, expected = {"hot": 1000, "k0": -3}, {}
    for seq, key, value, _ in sorted(rows, key=lambda r: r[0]):
        sums[key] = sums.get(key, 0) + (value or 0)
        expected[seq] = sums[key]
    assert {r.seq: r.s for r in found.collect()} == expected


def test_assign_ids(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(1000), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    result = [(r.a, r.b, r.id) for r in assign_ids(df, ["a", "b"], start=14).collect()]
    expected = [(a, b, 14 + n) for n, (a, b) in enumerate(sorted(rows))]
    assert sorted(result) == sorted(expected)


def test_assign_ids_descending_with_empty_ranges(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    result = {r.a: r.n for r in assign_ids(df, [F.desc("a")], into="n", partitions=16).collect()}
    assert result == {3: 1, 2: 2, 1: 3}


def test_new_rows_continue_the_ids_in_use(spark):
    existing = spark.createDataFrame([(4,), (17,)], "id int")
    assert (next_id(existing), next_id(existing.limit(0))) == (18, 1)
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    result = assign_ids(new, ["name"], start=next_id(existing)).collect()
    assert {r.name: r.id for r in result} == {"a": 18, "b": 19}


def test_copies_of_one_row_are_spread_over_the_ranges(spark, monkeypatch):
    written = []

    def keep(df):
        written.append(cut_lineage(df))
        return written[-1]

    monkeypatch.setattr("verdure.operators.identity.cut_lineage", keep)
    df = spark.createDataFrame([(1,)] * 400 + [(2,)] * 10, "a int").repartition(8)
    numbered = assign_ids(df, ["a"], partitions=8)
    assert sorted(r.id for r in numbered.where("a = 1").collect()) == list(range(1, 401))
    assert sorted(r.id for r in numbered.where("a = 2").collect()) == list(range(401, 411))
    ranges = written[0].where("a = 1").groupBy(F.shiftright("_slot", 33)).count().collect()
    assert len(ranges) >= 4 and max(r["count"] for r in ranges) <= 150


def test_dense_ranks(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 9, 1, 1, 7, None]], "v int")
    upward = dense_ranks(df, "v").collect()
    assert len(upward) == 7
    assert {r.v: r["rank"] for r in upward} == {1: 1, 5: 2, 7: 3, 9: 4, None: 5}
    downward = dense_ranks(df, "v", highest=True).collect()
    assert {r.v: r["rank"] for r in downward} == {None: 1, 9: 2, 7: 3, 5: 4, 1: 5}


def test_fill_defaults(spark):
    given = spark.createDataFrame([(1, 2, 3, None)], "id int, id_flower int, amount int, id_greenhouse int")
    row = fill_defaults(given, CATALOG["flower_warehouse"], "2020-02-29").collect()[0]
    assert str(row["date"]) == "2020-02-29"
    assert row["id_greenhouse"] is None  # present, so not replaced
    absent = fill_defaults(given.drop("id_greenhouse"), CATALOG["flower_warehouse"], "2020-02-29")
    assert absent.collect()[0]["id_greenhouse"] == 1
    staff = fill_defaults(spark.createDataFrame([(1,)], "id int"), CATALOG["staff"]).collect()[0]
    assert (staff["salary"], staff["allowance"], staff["name"]) == (100, 0, None)
    sale = fill_defaults(spark.createDataFrame([(1,)], "id int"), CATALOG["sale"], "2020-02-29").collect()[0]
    assert (str(sale["buy_date"]), sale["status"]) == ("2020-02-29 00:00:00", "not processed")


def test_increment(spark):
    df = spark.createDataFrame([(1,), (None,)], "i int")
    assert [r[0] for r in df.select(increment(F.col("i"))).collect()] == [2, None]
    top = spark.createDataFrame([(2147483647,)], "i int")
    with pytest.raises(Exception, match="OVERFLOW"):
        top.select(increment(F.col("i"))).collect()


def expected_names(rows):
    rows = list(dict.fromkeys(rows))
    children = {}
    for id_, parent, name in rows:
        children.setdefault(parent, []).append((id_, name))
    found = {}
    pending = [(id_, "") for id_, _ in children.get(None, [])]
    while pending:
        id_, path = pending.pop()
        found[id_] = path
        pending += [(child, f"{path} {name}") for child, name in children.get(id_, [])]
    return {id_: found.get(id_) for id_, _, _ in rows}


def names_of(spark, rows):
    df = spark.createDataFrame(rows, "id int, id_parent int, name string")
    result = full_names(df).collect()
    assert len(result) == len({r.id for r in result})
    return {r.id: r.fullname for r in result}


def test_full_names_of_a_long_chain(spark):
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(300)]
    assert names_of(spark, rows) == expected_names(rows)


def test_full_names_of_cycles_orphans_and_duplicates(spark):
    rows = [
        (1, None, "root"),
        (2, 1, "a"),
        (2, 1, "a"),  # the same row again
        (3, 2, "b"),
        (4, 5, "c"),  # 4 and 5 form a cycle
        (5, 4, "d"),
        (6, 5, "below the cycle"),
        (7, 99, "orphan"),
        (8, 7, "below the orphan"),
        (9, 9, "own parent"),
    ]
    assert names_of(spark, rows) == expected_names(rows)
    assert names_of(spark, rows)[6] is None


def test_full_names_of_random_forests(spark):
    for seed in range(3):
        draw = random.Random(seed)
        rows = [
            (i, draw.choice([None, draw.randrange(60), 0]) if i else None, f"n{i}") for i in range(60)
        ]
        assert names_of(spark, rows) == expected_names(rows)


def test_full_names_agree_with_a_recursive_query(spark):
    draw = random.Random(11)
    rows = [(i, draw.randrange(i) if i > 3 else None, f"n{i}") for i in range(80)]
    spark.createDataFrame(rows, "id int, id_parent int, name string").createOrReplaceTempView("node")
    sql = spark.sql(
        "WITH RECURSIVE path(id, fullname) AS (SELECT id, '' FROM node WHERE id_parent IS NULL"
        " UNION ALL SELECT n.id, concat(p.fullname, ' ', n.name) FROM node n JOIN path p"
        " ON p.id = n.id_parent) SELECT * FROM path"
    )
    assert names_of(spark, rows) == {r.id: r.fullname for r in sql.collect()}


def test_names_of_chosen_nodes(spark):
    rows = [(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 2, "d"), (5, 99, "e"), (6, 7, "f"), (7, 6, "g")]
    nodes = spark.createDataFrame(rows, "id int, id_parent int, name string")
    keys = spark.createDataFrame([(3,), (3,), (1,), (5,), (6,), (50,)], "k int")
    found = {r.id: r.fullname for r in full_names(nodes, keys=keys).collect()}
    assert found == {3: " b c", 1: "", 5: None, 6: None}
    touched = {r.id for r in ancestry(nodes, keys.where("k = 3")).collect()}
    assert touched == {1, 2, 3}


def test_running_total_of_one_key_with_ids_far_apart(spark):
    step = 1 << 41
    rows = spark.range(0, 3000).select(
        F.lit(7).alias("k"), (F.col("id") * step).alias("id"), F.lit(2).alias("v")
    )
    found = running_total(rows, "k", "id", "v", "total", ranges=50)
    assert found.where(F.col("total") != (F.col("id") / step + 1) * 2).count() == 0
    assert found.count() == 3000
