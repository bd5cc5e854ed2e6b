"""Data-quality rules derived from the catalog.

Row rules (NOT NULL, width, status words, mail form, value checks), keys and
references of a table are all judged in one scan, and those of all tables in one
shuffle, see ``judge``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.functions.periods import AsOf, as_of_date
from verdure.operators.joins import join_by_key
from verdure.sources.catalog import (
    ADDRESS,
    ADDRESS_WIDTHS,
    CATALOG,
    EMAIL_PATTERN,
    TODAY,
    Reference,
    Relation,
)

Rules = dict[str, Column]


def _condition(text: str, as_of: AsOf) -> Column:
    if TODAY not in text:
        return F.expr(text)
    left, right = text.split(TODAY)
    if right or not left.rstrip().endswith("<="):
        raise ValueError(f"unsupported date rule: {text}")
    return F.col(left.rstrip()[:-2].strip()) <= as_of_date(as_of)


def null_rules(relation: Relation) -> Rules:
    """A required column is NULL."""
    return {f"not_null:{f.name}": F.col(f.name).isNull() for f in relation.fields if f.required}


def check_rules(relation: Relation, as_of: AsOf = None) -> Rules:
    """A value check is false; one that is NULL passes."""
    return {f"check:{text}": ~_condition(text, as_of) for text in relation.checks}


def email_rules(relation: Relation) -> Rules:
    return {
        f"email:{f.name}": ~F.col(f.name).rlike(EMAIL_PATTERN) for f in relation.fields if f.email
    }


def enum_rules(relation: Relation) -> Rules:
    return {
        f"enum:{f.name}": ~F.col(f.name).isin(*f.allowed) for f in relation.fields if f.allowed
    }


def length_rules(relation: Relation) -> Rules:
    rules = {}
    for f in relation.fields:
        if f.width is not None:
            rules[f"length:{f.name}"] = F.char_length(f.name) > f.width
        if f.type == ADDRESS:
            for part, width in ADDRESS_WIDTHS.items():
                name = f"{f.name}.{part}"
                rules[f"length:{name}"] = F.char_length(F.col(name)) > width
    return rules


def key_rules(relation: Relation) -> Rules:
    """A part of the primary key is NULL."""
    if not relation.key:
        return {}
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in relation.key])
    return {f"{_key_label(relation)}:null": missing}


def _key_label(relation: Relation) -> str:
    return f"primary_key:{','.join(relation.key)}"


def row_rules(relation: Relation, as_of: AsOf = None) -> Rules:
    return {
        **null_rules(relation),
        **length_rules(relation),
        **enum_rules(relation),
        **email_rules(relation),
        **check_rules(relation, as_of),
    }


def row_violations(df: DataFrame, rules: Rules) -> DataFrame:
    """The violating rows, once per broken rule, with the rule's name."""
    broken = [F.when(broken, F.lit(rule)) for rule, broken in rules.items()]
    return (
        df.withColumn("rules", F.array_compact(F.array(*broken)))
        .where(F.size("rules") > 0)
        .withColumn("rule", F.explode("rules"))
        .drop("rules")
    )


def count_row_violations(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """``table_name, rule, violations``, one row per rule, in one scan."""
    # One aggregate row, turned into as many rows as there are rules.
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.count_if(broken).alias("violations"))
                for rule, broken in rules.items()
            ]
        ).alias("counts")
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline("counts"))


def repeated_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    A key with a NULL part never equals another one.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return (
        df.where(present)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def orphan_keys(child: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """Referenced keys without a parent row, with the number of rows that use them."""
    used = (
        child.where(F.col(reference.column).isNotNull())
        .groupBy(reference.column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    keys = parent.select(F.col("id").alias("_id"))
    return used.join(keys, F.col(reference.column) == F.col("_id"), "left_anti")


def orphan_rows(child: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """The rows themselves that refer to a missing parent."""
    missing = orphan_keys(child, reference, parent).select(F.col(reference.column).alias("_missing"))
    return join_by_key(child, reference.column, missing, "_missing", "left_semi")


@dataclass(frozen=True)
class Rule:
    """A declared rule: a broken condition, a key that must not repeat, or a reference."""

    table: str
    name: str
    condition: Column | None = None
    key: tuple[str, ...] = ()
    reference: Reference | None = None


def declared_rules(relation: Relation, as_of: AsOf = None) -> list[Rule]:
    """All rules of a table: row rules, the primary key, unique columns and references."""
    conditions = {**row_rules(relation, as_of), **key_rules(relation)}
    rules = [Rule(relation.name, name, condition) for name, condition in conditions.items()]
    if relation.key:
        rules.append(Rule(relation.name, _key_label(relation), key=relation.key))
    rules += [Rule(relation.name, f"unique:{c}", key=(c,)) for c in relation.unique]
    rules += [
        Rule(relation.name, f"foreign_key:{r.column}->{r.parent}", reference=r) for r in relation.references
    ]
    return rules


# Broken conditions of a row are the bits of a whole number.
MASK_BITS = 62
_CONDITION, _KEY, _REFERENCE = 0, 1, 2


def _key_value(df: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """A key as two whole numbers and a text, the same for keys of the same values."""
    whole = [isinstance(df.schema[c].dataType, T.IntegralType) for c in columns]
    number, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if all(whole) and len(columns) <= 2:
        parts = [F.col(c).cast("bigint") for c in columns]
        return [*parts, number][:2] + [text]
    if len(columns) == 1:
        return [number, number, F.col(columns[0]).cast("string")]
    return [number, number, F.to_json(F.struct(*columns))]


def _entry(slot: int, value: list[Column], owner: bool) -> Column:
    a, b, text = value
    return F.struct(
        F.lit(slot).alias("slot"), a.alias("a"), b.alias("b"), text.alias("t"), F.lit(owner).alias("owner")
    )


def _places(rules: list[Rule]) -> list[tuple[int, int]]:
    """Slot and bit of each rule.

    A key has a slot, and a reference shares one with the key of its parent. A
    further reference to the same parent has a slot of its own, in which the
    parent's keys come again, so that every slot needs two counts. The
    conditions of a table share slots below 0, a bit each.
    """
    keys = {key: slot for slot, key in enumerate(dict.fromkeys((r.table, r.key) for r in rules if r.key))}
    found, taken, masks, last, lowest = [], set(), {}, len(keys), 0
    for rule in rules:
        if rule.condition is not None:
            slot, bit = masks.get(rule.table, (0, MASK_BITS))
            if bit == MASK_BITS:
                slot, bit, lowest = lowest - 1, 0, lowest - 1
            masks[rule.table] = slot, bit + 1
            found.append((slot, bit))
        elif rule.key:
            found.append((keys[rule.table, rule.key], 0))
        else:
            shared = keys.get((rule.reference.parent, ("id",)))
            if shared is None or shared in taken:
                shared, last = last, last + 1
            taken.add(shared)
            found.append((shared, 0))
    return found


def _entries(name: str, df: DataFrame, rules: list[Rule], places: list[tuple[int, int]]) -> list[Column]:
    """What a row of the table says: broken conditions, the keys it has and the keys it uses."""
    nothing = [F.lit(None).cast("bigint"), F.lit(None).cast("string")]
    masks, owned, found = {}, {}, []
    for rule, (slot, bit) in zip(rules, places, strict=True):
        if rule.condition is not None and rule.table == name:
            masks.setdefault(slot, []).append(F.when(rule.condition, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
        elif rule.key and rule.table == name:
            owned[slot] = rule.key
        elif rule.reference:
            if rule.reference.parent == name:
                owned[slot] = ("id",)
            if rule.table == name:
                column = rule.reference.column
                entry = _entry(slot, _key_value(df, (column,)), False)
                found.append(F.when(F.col(column).isNotNull(), entry))
    for slot, bits in masks.items():
        mask = reduce(lambda a, b: a + b, bits)
        found.append(F.when(mask > 0, _entry(slot, [mask, *nothing], False)))
    for slot, key in owned.items():
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        found.append(F.when(present, _entry(slot, _key_value(df, key), True)))
    return found


def judge(tables: Mapping[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """``table_name, rule, violations`` for the rules given, in one scan per table.

    Every row is turned into entries for the rules it breaks, the keys it has and
    the keys it uses. The entries of all tables are stacked and counted by key
    before and in one shuffle, so a key with most of the rows costs one row per
    task; then each key knows how often it is had and used. A repeated key counts
    its surplus rows, a reference the rows whose key nobody has. A key with a
    NULL part never equals another one. Where the parent table is not given,
    violations are NULL: not checked.
    """
    spark = next(iter(tables.values())).sparkSession
    checked = [r.reference is None or r.reference.parent in tables for r in rules]
    judged = [r for r, c in zip(rules, checked, strict=True) if c]
    places = _places(judged)
    stacked = []
    for name, df in tables.items():
        entries = _entries(name, df, judged, places)
        if entries:
            stacked.append(df.select(F.explode(F.array(*entries)).alias("x")).where("x IS NOT NULL").select("x.*"))
    at = iter(places)
    listed = [
        (n, r.table, r.name, c, *(next(at) if c else (None, 0)))
        + (_CONDITION if r.condition is not None else _KEY if r.key else _REFERENCE,)
        for n, (r, c) in enumerate(zip(rules, checked, strict=True))
    ]
    every = spark.createDataFrame(
        listed, "number int, table_name string, rule string, checked boolean, place int, bit int, kind int"
    )
    if not stacked:
        return every.select("table_name", "rule", F.lit(None).cast("bigint").alias("violations"))
    counted = (
        reduce(DataFrame.unionAll, stacked)
        .groupBy("slot", "a", "b", "t")
        .agg(F.count_if("owner").alias("had"), F.count_if(~F.col("owner")).alias("used"))
    )
    none = F.lit(0).cast("bigint")
    found = (
        counted.where("had <> 1")
        .groupBy("slot", F.when(F.col("slot") < 0, F.col("a")).alias("mask"))
        .agg(
            F.sum(F.when(F.col("had") > 1, F.col("had") - 1).otherwise(none)).alias("surplus"),
            F.sum(F.when(F.col("had") == 0, F.col("used")).otherwise(none)).alias("missing"),
        )
    )
    own = (
        F.when(F.col("kind") == _KEY, F.col("surplus"))
        .when(F.col("kind") == _REFERENCE, F.col("missing"))
        .when(F.expr("shiftright(mask, bit) & 1 = 1"), F.col("missing"))
    )
    return (
        every.join(found, F.col("place") == F.col("slot"), "left")
        .groupBy("number", "table_name", "rule", "checked")
        .agg(F.sum(own).alias("found"))
        .select("table_name", "rule", F.when(F.col("checked"), F.coalesce("found", none)).alias("violations"))
    )


def count_key_violations(df: DataFrame, relation: Relation) -> DataFrame:
    """Surplus rows per repeated primary key, and rows with a NULL in it."""
    rules = [r for r in declared_rules(relation) if r.name.startswith("primary_key:")]
    return judge({relation.name: df}, rules)


def count_unique_violations(df: DataFrame, relation: Relation) -> DataFrame:
    """Surplus rows per repeated value of the unique columns."""
    return judge({relation.name: df}, [r for r in declared_rules(relation) if r.name.startswith("unique:")])


def count_orphans(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Rows per reference of the tables ``names`` that point nowhere."""
    rules = [r for name in names for r in declared_rules(CATALOG[name]) if r.reference]
    needed = {*names, *(r.reference.parent for r in rules)}
    return judge({name: tables[name] for name in tables if name in needed}, rules)


def quality_report(tables: Mapping[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """``table_name, rule, violations`` for every declared rule of the given tables.

    A reference whose parent is not among them has NULL violations: not checked.
    """
    return judge(tables, [r for name in tables for r in declared_rules(CATALOG[name], as_of)])
