from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.operators import quality
from verdure.sources.catalog import ADDRESS, CATALOG, Relation

AS_OF = "2020-01-01"


def sound_value(field, number):
    if field.allowed:
        return field.allowed[0]
    if field.email:
        return f"user{number}@post.example"
    if field.type == ADDRESS:
        return ("1", "Port", "Sea lane", None)
    return {
        T.StringType: f"name {number}",
        T.IntegerType: number,
        T.LongType: number,
        T.DecimalType: Decimal(number),
        T.DateType: dt.date(2019, 5, 5),
        T.TimestampNTZType: dt.datetime(2019, 5, 5),
        T.BooleanType: True,
        T.BinaryType: bytearray(b"x"),
    }[type(field.type)]


def sound_tables(spark):
    """Two sound rows in each of the declared tables; keys and references are 1 and 2."""
    return {
        name: spark.createDataFrame(
            [tuple(sound_value(f, n) for f in relation.fields) for n in (1, 2)], relation.schema
        )
        for name, relation in CATALOG.items()
    }


@pytest.fixture(scope="module")
def sound(spark):
    return sound_tables(spark)


def test_sound_tables_break_no_rule(sound):
    some = {name: sound[name] for name in ("user", "flower", "sale", "sale_detail", "adress_sale")}
    report = quality.quality_report(some, AS_OF).collect()
    assert len(report) > 30 and not [r for r in report if r.violations]


def quality_rule_names(relation):
    names = [f"not_null:{f.name}" for f in relation.fields if f.required]
    names += [f"length:{f.name}" for f in relation.fields if f.width]
    names += [f"enum:{f.name}" for f in relation.fields if f.allowed]
    names += [f"email:{f.name}" for f in relation.fields if f.email]
    for f in relation.fields:
        if f.type == ADDRESS:
            names += [f"length:{f.name}.{part}" for part in ADDRESS.names]
    return names + [f"check:{text}" for text in relation.checks]


def spoilt_row(relation, rule):
    """A sound row with one value changed so that only ``rule`` is broken."""
    row = {f.name: sound_value(f, 1) for f in relation.fields}
    kind, _, what = rule.partition(":")
    name, _, part = what.partition(" ")[0].partition(".")
    if part:
        row[name] = tuple("x" * 40 if p == part else "x" for p in ADDRESS.names)
    elif kind == "not_null":
        row[name] = None
    elif kind == "length":
        row[name] = "x" * (relation.field(name).width + 1)
    elif kind == "check":
        is_date = isinstance(relation.field(name).type, T.DateType)
        row[name] = dt.date(2020, 1, 2) if is_date else type(row[name])(0)
    else:
        row[name] = "neither word nor mail\n"
    return tuple(row.values())


@pytest.mark.parametrize("name", [n for n in CATALOG if n != "sale_sum"])
def test_every_row_rule_finds_its_flaw(spark, name):
    relation = CATALOG[name]
    expected = quality_rule_names(relation)
    rules = quality.row_rules(relation, AS_OF)
    assert sorted(rules) == sorted(expected)
    rows = [(rule, *spoilt_row(relation, rule)) for rule in expected]
    schema = T.StructType([T.StructField("flaw", T.StringType()), *relation.schema.fields])
    df = spark.createDataFrame(rows, schema)
    found = quality.row_violations(df, rules).select("flaw", "rule").collect()
    assert sorted(map(tuple, found)) == sorted((rule, rule) for rule in expected)
    counted = quality.count_row_violations(df, name, rules).collect()
    assert {(r.table_name, r.rule, r.violations) for r in counted} == {(name, rule, 1) for rule in expected}


def test_null_passes_a_check_but_not_beside_a_false_part(spark):
    rules = quality.check_rules(CATALOG["sale"])
    rows = [(1, 1, None), (2, 0, None), (3, 1, 1), (4, 1, 0)]
    df = spark.createDataFrame(rows, "id int, id_user int, id_adress int")
    assert sorted(r.id for r in quality.row_violations(df, rules).collect()) == [2, 4]


@pytest.mark.parametrize(
    ("mail", "sound_mail"),
    [("a@b", True), ("a.b@c-d.e", True), ("a@b\n", False), ("a@", False), ("@b", False), ("a b@c", False), ("a@-b", False)],
)
def test_mail_rule(spark, mail, sound_mail):
    df = spark.createDataFrame([(mail,)], "e_mail string")
    broken = quality.row_violations(df, quality.email_rules(CATALOG["user"])).count()
    assert broken == (0 if sound_mail else 1)


def test_keys(spark):
    rows = [(1, 1), (1, 1), (1, 2), (None, 2), (None, 2), (2, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert [tuple(r) for r in quality.repeated_keys(df, ("a", "b")).collect()] == [(1, 1, 2)]
    rules = quality.key_rules(Relation("t", (), key=("a", "b")))
    assert [r.violations for r in quality.count_row_violations(df, "t", rules).collect()] == [3]


def test_unique_ignores_nulls(spark, sound):
    twice = sound["user"].withColumn("e_mail", F.lit("same@post"))
    none = sound["user"].withColumn("e_mail", F.lit(None).cast("string"))
    for df, expected in ((twice, 1), (none, 0)):
        counted = quality.count_unique_violations(df, CATALOG["user"])
        assert [r.violations for r in counted.collect()] == [expected]


def test_every_reference_finds_its_orphan(sound):
    parts = []
    for name, relation in CATALOG.items():
        for reference in relation.references:
            child = sound[name].withColumn(
                reference.column, F.when(F.col(reference.column) == 1, 77).cast("int")
            )
            # The other row has NULL, which refers to nothing.
            keys = quality.orphan_keys(child, reference, sound[reference.parent])
            rows = quality.orphan_rows(child, reference, sound[reference.parent])
            parts.append(keys.select(F.col(reference.column).alias("key"), "row_count"))
            parts.append(rows.select(F.col(reference.column).alias("key"), F.lit(1).cast("bigint")))
    for start in range(0, len(parts), 20):
        group = parts[start : start + 20]
        found = reduce(lambda x, y: x.union(y), group).collect()
        assert [tuple(r) for r in found] == [(77, 1)] * len(group)


def test_report_names_the_flaws(spark, sound):
    tables = {name: sound[name] for name in ("user", "sale", "sale_detail", "flower")}
    tables["sale_detail"] = sound["sale_detail"].withColumn("amount", F.lit(-1))
    tables["sale"] = sound["sale"].withColumn("id", F.lit(1))
    found = {
        (r.table_name, r.rule): r.violations
        for r in quality.quality_report(tables, AS_OF).collect()
        if r.violations
    }
    assert found == {
        ("sale_detail", "check:amount > 0"): 2,
        ("sale", "primary_key:id"): 1,
        ("sale_detail", "foreign_key:id_sale->sale"): 1,
    }


def test_every_reference_of_the_report_finds_its_orphan(sound):
    """All 27 tables at once: two rows per reference, of which one points nowhere."""
    spoilt = dict(sound)
    for name, relation in CATALOG.items():
        for reference in relation.references:
            column = F.when(F.col(reference.column) == 1, 77).otherwise(F.col(reference.column)).cast("int")
            spoilt[name] = spoilt[name].withColumn(reference.column, column)
    report = quality.quality_report(spoilt, AS_OF).collect()
    found = {(r.table_name, r.rule): r.violations for r in report}
    references = [(n, f"foreign_key:{r.column}->{r.parent}") for n, t in CATALOG.items() for r in t.references]
    assert len(references) == 29 and all(found[r] == 1 for r in references)
    assert len(report) == sum(len(quality.declared_rules(t)) for t in CATALOG.values())
    assert not [k for k, v in found.items() if v and k not in references]


def test_keys_of_the_report(spark, sound):
    tables = {n: df.unionByName(df.where("id = 2") if "id" in df.columns else df.limit(1)) for n, df in sound.items()}
    report = quality.quality_report(tables, AS_OF).collect()
    found = {(r.table_name, r.rule): r.violations for r in report if r.violations}
    keys = {(n, f"primary_key:{','.join(t.key)}"): 1 for n, t in CATALOG.items() if t.key}
    unique = {(n, f"unique:{c}"): 1 for n, t in CATALOG.items() for c in t.unique}
    assert found == {**keys, **unique}
    assert (len(keys), len(unique)) == (26, 8)


def test_judging_scans_each_table_once(spark, tmp_path, sound):
    stored = {}
    for name in ("flower", "sale", "sale_detail"):
        sound[name].write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.schema(CATALOG[name].schema).parquet(f"{tmp_path}/{name}")
    plan = quality.quality_report(stored, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3


def test_judging_a_hot_key_and_text_keys(spark):
    relation = Relation("t", (), key=("a", "b"), unique=("name",))
    rows = [(1, 1, "x")] * 500 + [(1, 2, "x"), (2, 1, "1"), (None, 1, None), (None, 1, None)]
    df = spark.createDataFrame(rows, "a int, b int, name string")
    found = {r.rule: r.violations for r in quality.judge({"t": df}, quality.declared_rules(relation)).collect()}
    assert found == {"primary_key:a,b": 499, "primary_key:a,b:null": 2, "unique:name": 500}


def test_a_reference_to_an_absent_table_is_not_checked(spark, sound):
    found = {r.rule: r.violations for r in quality.quality_report({"sale_detail": sound["sale_detail"]}).collect()}
    assert found["foreign_key:id_sale->sale"] is None and found["check:amount > 0"] == 0


def test_entries_are_dealt_out_once(spark):
    """Keys and references of all tables meet in one shuffle, with references that share a parent apart."""
    flowers = [(1, None, "a"), (2, 1, "b"), (2, 8, "b"), (None, 1, "c")]
    lines = [(1, 1, 1, 2), (2, 2, 9, -1), (3, 3, None, 1), (3, 4, 9, 1)]
    tables = {
        "flower": spark.createDataFrame(flowers, CATALOG["flower"].schema.simpleString().replace("struct<", "")[:-1]),
        "sale_detail": spark.createDataFrame(lines, "id int, id_sale int, id_flower int, amount int"),
    }
    report = quality.quality_report(tables)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(slot#\d+, a#\d+", plan)) == 1
    found = {(r.table_name, r.rule): r.violations for r in report.collect()}
    broken = {key: n for key, n in found.items() if n}
    assert broken == {
        ("flower", "not_null:id"): 1,
        ("flower", "primary_key:id:null"): 1,
        ("flower", "primary_key:id"): 1,
        ("flower", "unique:name"): 1,
        ("flower", "foreign_key:id_parent->flower"): 1,
        ("sale_detail", "not_null:id_flower"): 1,
        ("sale_detail", "check:amount > 0"): 1,
        ("sale_detail", "primary_key:id"): 1,
        ("sale_detail", "foreign_key:id_flower->flower"): 2,
    }
    assert found["sale_detail", "foreign_key:id_sale->sale"] is None


def test_more_conditions_than_bits(spark):
    rows = spark.createDataFrame([(n, 1) for n in range(200)], "id int, amount int")
    rules = [quality.Rule("sale_detail", f"at most {n}", F.col("id") > n) for n in range(150)]
    found = {r.rule: r.violations for r in quality.judge({"sale_detail": rows}, rules).collect()}
    assert found == {f"at most {n}": 199 - n for n in range(150)}
