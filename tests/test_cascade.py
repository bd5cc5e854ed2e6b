from __future__ import annotations

import plain_reports as plain
import pytest
from nursery_rows import FLOWERS, LINE_LOTS, SALES
from test_quality import sound_tables

from verdure.operators import cascade
from verdure.sources.catalog import CATALOG


def plan_deletion(tables, root, keys):
    return cascade.plan_deletion(tables, root, keys, set(CATALOG) - set(tables))


def change_keys(tables, root, changes):
    return cascade.change_keys(tables, root, changes, set(CATALOG) - set(tables))


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def key(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_deletion_follows_owned_rows(spark, nursery):
    deletion = plan_deletion(nursery, "sale", key(spark, 70, 79))
    gone = plain.lines_of(70, 79)
    assert ids(deletion.doomed["sale_detail"]) == gone == [3000, 3005, 3030, 3035]
    assert ids(deletion.doomed["sale_flower"], "id_sale_detail") == plain.lots_of(gone)
    kept = deletion.apply()
    assert ids(kept["sale"]) == sorted(s[0] for s in SALES if s[0] not in (70, 79))
    assert kept["sale_flower"].count() == len(LINE_LOTS) - 5
    assert kept["flower"].count() == len(FLOWERS)


def test_rows_with_two_doomed_parents_go_once(spark, nursery):
    deletion = plan_deletion(nursery, "flower", key(spark, 312))
    assert ids(deletion.doomed["flower_warehouse"]) == [6010]
    assert ids(deletion.doomed["sale_detail"]) == [3005, 3040]
    assert ids(deletion.doomed["sale_flower"], "id_sale_detail") == [3005, 3040]
    assert deletion.apply()["sale_flower"].count() == len(LINE_LOTS) - 2


def test_one_marked_pass_parts_a_table(spark, nursery):
    deletion = plan_deletion(nursery, "flower", key(spark, 312, 411))
    assert set(deletion.marked) == {"flower", "flower_warehouse", "sale_detail", "sale_flower"}
    for name, marked in deletion.marked.items():
        parts = {r[cascade.DOOMED]: r["count"] for r in marked.groupBy(cascade.DOOMED).count().collect()}
        assert parts.get(True, 0) == deletion.doomed[name].count()
        assert parts.get(False, 0) == deletion.kept[name].count()
        assert marked.drop(cascade.DOOMED).schema == nursery[name].schema


def test_each_table_is_scanned_once(spark, tmp_path, nursery):
    stored = {}
    for name, df in nursery.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.schema(CATALOG[name].schema).parquet(f"{tmp_path}/{name}")
    deletion = plan_deletion(stored, "flower", key(spark, 312))
    plan = deletion.marked["sale_flower"]._jdf.queryExecution().optimizedPlan().toString()
    # The lines and the lots of the lost product, and the bridge rows themselves; of products, their keys.
    for name, column in (("sale_flower", "id_flower_warehouse"), ("flower_warehouse", "ready_to_sale"), ("sale_detail", "id_sale")):
        relations = [x for x in plan.splitlines() if "Relation [" in x and f"{column}#" in x]
        assert len(relations) == 1, name


def test_children_block_unless_they_go_too(spark, nursery):
    deletion = plan_deletion(nursery, "flower", key(spark, 212))
    assert [tuple(r) for r in deletion.blockers.collect()] == [("flower", "id_parent", 212, 2)]
    with pytest.raises(ValueError, match="id_parent"):
        deletion.apply()
    whole = plan_deletion(nursery, "flower", key(spark, 212, 313, 314, 412))
    assert whole.blockers.count() == 0
    assert ids(whole.apply()["flower_warehouse"]) == [6001, 6003, 6010, 6030, 6031, 6040]


def test_users_of_orders_block(spark, nursery):
    deletion = plan_deletion(nursery, "user", key(spark, 801))
    assert [tuple(r) for r in deletion.blockers.collect()] == [("sale", "id_user", 801, 3)]


def test_dead_flowers_block_a_deletion_two_levels_up(spark):
    tables = sound_tables(spark)
    tables["flower"] = tables["flower"].selectExpr("id", "CAST(NULL AS INT) AS id_parent", "name")
    deletion = plan_deletion(tables, "flower", key(spark, 1))
    assert [tuple(r) for r in deletion.blockers.collect()] == [("dead_flowers", "id_flower_warehouse", 1, 1)]
    del tables["dead_flowers"]
    kept = plan_deletion(tables, "flower", key(spark, 1)).apply()
    for name in ("flower", "flower_warehouse", "sale_detail", "sale_flower", "purchase_detail", "disease_flower", "pest_flower"):
        assert kept[name].count() == 1, name
    assert kept["sale"].count() == 2


def test_nothing_to_delete(spark, nursery):
    deletion = plan_deletion(nursery, "sale", key(spark, 999))
    assert deletion.apply()["sale_flower"].count() == len(LINE_LOTS)


def test_key_change_reaches_every_reference(spark, nursery):
    changes = spark.createDataFrame([(110, 910), (313, 913)], "o int, n int")
    changed = change_keys(nursery, "flower", changes)
    flower = {r.id: r.id_parent for r in changed.tables["flower"].collect()}
    assert flower[316] == 910 and flower[412] == 913 and 910 in flower and 110 not in flower
    assert changed.blockers.count() == 0
    moved = change_keys(nursery, "flower", spark.createDataFrame([(411, 911)], "o int, n int"))
    assert ids(moved.tables["sale_detail"].where("id_flower = 911")) == [3000, 3010, 3030, 3055]
    assert ids(moved.tables["flower_warehouse"].where("id_flower = 911")) == [6001, 6003]
    assert moved.tables["sale_detail"].schema == nursery["sale_detail"].schema


def test_dead_flowers_block_a_key_change(spark):
    tables = sound_tables(spark)
    changes = spark.createDataFrame([(1, 9), (2, 2)], "o int, n int")
    blockers = change_keys(tables, "flower_warehouse", changes).blockers.collect()
    assert [tuple(r) for r in blockers] == [("dead_flowers", "id_flower_warehouse", 1, 1)]


def test_a_swap_of_keys_does_not_chain(spark, nursery):
    changes = spark.createDataFrame([(411, 412), (412, 411)], "o int, n int")
    lines = {r.id: r.id_flower for r in change_keys(nursery, "flower", changes).tables["sale_detail"].collect()}
    assert lines[3000] == 412 and lines[3020] == 411


def test_absent_tables_are_refused(spark, nursery):
    few = {name: nursery[name] for name in ("flower", "sale_flower", "sale")}
    with pytest.raises(ValueError, match="flower_warehouse.*sale_detail"):
        cascade.plan_deletion(few, "flower", key(spark, 10))
    with pytest.raises(ValueError, match="sale_detail"):
        cascade.change_keys(few, "flower", spark.createDataFrame([(1, 2)], "o int, n int"))


def test_changes_that_collide_are_refused(spark, nursery):
    rows = [(312, 411), (314, 1112), (314, 1113), (315, 1200), (316, 1200)]
    change = change_keys(nursery, "flower", spark.createDataFrame(rows, "o int, n int"))
    found = sorted(tuple(r) for r in change.blockers.collect())
    assert found == [
        ("flower", "id:changed_twice", 314, 2),
        ("flower", "id:taken", 411, 2),
        ("flower", "id:taken", 1200, 2),
    ]
    assert change.tables["sale_detail"].count() == nursery["sale_detail"].count()
    with pytest.raises(ValueError, match="forbids"):
        change.apply()
    fine = change_keys(nursery, "flower", spark.createDataFrame([(312, 912)], "o int, n int"))
    assert 912 in ids(fine.apply()["flower"])
