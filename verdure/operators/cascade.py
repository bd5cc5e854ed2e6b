"""Deletions and key changes that follow the declared references."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.operators.joins import join_by_key
from verdure.sources.catalog import CATALOG, Reference, Relation

Tables = Mapping[str, DataFrame]


DOOMED = "_doomed"


@dataclass(frozen=True)
class Deletion:
    """What a deletion would do; nothing is deleted where ``blockers`` has rows.

    ``marked`` holds each table that the deletion reaches with the flag
    ``DOOMED``: one pass that parts a table. ``kept`` and ``doomed`` are filters
    of it; ``kept`` also has the tables that are not reached.
    """

    kept: dict[str, DataFrame]
    doomed: dict[str, DataFrame]
    blockers: DataFrame
    marked: dict[str, DataFrame]

    def apply(self) -> dict[str, DataFrame]:
        """The tables after the deletion; refuses if a row blocks it."""
        blocked = self.blockers.take(1)
        if blocked:
            row = blocked[0]
            raise ValueError(
                f"{row['table_name']}.{row['column_name']} still refers to deleted key {row['parent_key']}"
            )
        return self.kept


def _refuse_absent(tables: Tables, parents: set[str], left_out: Iterable[str], follow: bool) -> None:
    """Raise for tables that refer to ``parents``, directly or (``follow``) through owned rows."""
    reached, needed = set(parents), set()
    while True:
        more = {
            name
            for name, relation in CATALOG.items()
            if any(r.parent in reached for r in relation.references)
        }
        needed |= more
        owned = {
            name
            for name in more - reached
            if any(r.on_delete_cascade and r.parent in reached for r in CATALOG[name].references)
        }
        if not follow or not owned - set(left_out):
            break
        reached |= owned - set(left_out)
    absent = sorted(needed - set(tables) - set(left_out))
    if absent:
        raise ValueError(f"tables that may be affected are absent: {', '.join(absent)}")


def _doomed_values(doomed: DataFrame) -> DataFrame:
    return doomed.select(F.col("id").alias("_gone")).distinct()


def _order(tables: Tables, root: str) -> list[str]:
    """Tables a deletion in ``root`` may reach, each after its parents."""
    reached, pending = [root], True
    while pending:
        pending = False
        for name in tables:
            parents = {r.parent for r in CATALOG[name].references if r.on_delete_cascade}
            if name not in reached and parents & set(reached):
                reached.append(name)
                pending = True
    done: list[str] = []
    while len(done) < len(reached):
        for name in reached:
            parents = {r.parent for r in CATALOG[name].references if r.on_delete_cascade}
            if name not in done and parents & set(reached) <= set(done):
                done.append(name)
    return done


def _owned_by(relation: Relation, doomed: Mapping[str, DataFrame]) -> list[Reference]:
    return [r for r in relation.references if r.on_delete_cascade and r.parent in doomed]


def plan_deletion(
    tables: Tables, root: str, keys: DataFrame, left_out: Iterable[str] = ()
) -> Deletion:
    """Delete the rows of ``root`` whose id is in the one-column ``keys``.

    The references are walked once, parents first: doomed rows are those with
    a doomed parent along an owning reference. Any other reference to a doomed
    row blocks the deletion unless the referring row is doomed as well. A table
    that the deletion could reach and that is neither given nor named in
    ``left_out`` is an error; what is left out is taken to have no rows.
    """
    _refuse_absent(tables, {root}, left_out, follow=True)
    victims = keys.toDF("_gone").where("_gone IS NOT NULL").distinct()
    marked = {root: _marked(tables[root], CATALOG[root], [("id", victims)])}
    doomed = {root: _parted(marked[root], True)}
    for name in _order(tables, root)[1:]:
        relation = CATALOG[name]
        gone = [(r.column, _doomed_values(doomed[r.parent])) for r in _owned_by(relation, doomed)]
        marked[name] = _marked(tables[name], relation, gone)
        doomed[name] = _parted(marked[name], True)
    kept = {**tables, **{name: _parted(df, False) for name, df in marked.items()}}
    return Deletion(kept, doomed, _blockers(tables, kept, doomed), marked)


def _marked(df: DataFrame, relation: Relation, gone: list[tuple[str, DataFrame]]) -> DataFrame:
    """``df`` with the flag ``DOOMED``: some column has a value that is gone."""
    flags = []
    for number, (column, values) in enumerate(gone):
        flag, value = f"_flag{number}", f"_gone{number}"
        lookup = values.select(F.col("_gone").alias(value), F.lit(True).alias(flag))
        df = join_by_key(df, column, lookup, value, "left", relation.key).drop(value)
        flags.append(flag)
    # Each value is listed once, so a row stays one row.
    found = F.coalesce(*flags, F.lit(False)) if flags else F.lit(False)
    return df.withColumn(DOOMED, found).drop(*flags)


def _parted(marked: DataFrame, doomed: bool) -> DataFrame:
    return marked.where(F.col(DOOMED) if doomed else ~F.col(DOOMED)).drop(DOOMED)


def _blockers(tables: Tables, kept: Tables, doomed: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, parent_key, row_count`` of surviving references."""
    parts = []
    for name in tables:
        for ref in CATALOG[name].references:
            if ref.on_delete_cascade or ref.parent not in doomed:
                continue
            used = kept[name].groupBy(F.col(ref.column).alias("parent_key")).agg(
                F.count(F.lit(1)).alias("row_count")
            )
            gone = _doomed_values(doomed[ref.parent])
            parts.append(
                used.join(gone, F.col("parent_key") == F.col("_gone"), "left_semi").select(
                    F.lit(name).alias("table_name"),
                    F.lit(ref.column).alias("column_name"),
                    F.col("parent_key").cast("bigint").alias("parent_key"),
                    "row_count",
                )
            )
    if parts:
        return reduce(DataFrame.unionByName, parts)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        [], "table_name string, column_name string, parent_key bigint, row_count bigint"
    )


@dataclass(frozen=True)
class KeyChange:
    """What a change of keys would do; nothing may change where ``blockers`` has rows."""

    tables: dict[str, DataFrame]
    blockers: DataFrame

    def apply(self) -> dict[str, DataFrame]:
        """The tables after the change; refuses if a row blocks it."""
        blocked = self.blockers.take(1)
        if blocked:
            row = blocked[0]
            raise ValueError(
                f"{row['table_name']}.{row['column_name']} forbids the change of key {row['parent_key']}"
            )
        return self.tables


def _replaced(df: DataFrame, column: str, changes: DataFrame) -> DataFrame:
    """``df`` with ``column`` taken from the change of its value, if there is one."""
    kind = df.schema[column].dataType
    changed = df.join(changes, F.col(column) == F.col("_old"), "left")
    value = F.coalesce(F.col("_new"), F.col(column)).cast(kind)
    return changed.withColumn(column, value).select(*df.columns)


def _blocker(table: str, column: str, found: DataFrame) -> DataFrame:
    return found.select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.col("parent_key").cast("bigint").alias("parent_key"),
        "row_count",
    )


def change_keys(
    tables: Tables, root: str, changes: DataFrame, left_out: Iterable[str] = ()
) -> KeyChange:
    """Change ids of ``root`` by an ``(old, new)`` table and carry them to all references.

    Blockers are references that do not follow, old keys that several changes
    name (column ``id:changed_twice``), and new keys that a surviving row or
    another change takes as well (``id:taken``). A NULL changes nothing. A
    referring table that is neither given nor named in ``left_out`` is an error.
    """
    _refuse_absent(tables, {root}, left_out, follow=False)
    given = changes.toDF("_old", "_new").where("_old IS NOT NULL AND _new IS NOT NULL")
    # One change per key, so that no row is ever multiplied.
    pairs = given.groupBy("_old").agg(F.min("_new").alias("_new"), F.count(F.lit(1)).alias("_times"))
    twice = pairs.where("_times > 1").select(
        F.col("_old").alias("parent_key"), F.col("_times").alias("row_count")
    )
    pairs = pairs.drop("_times")
    changed = dict(tables)
    changed[root] = _replaced(tables[root], "id", pairs)
    targets = pairs.where("_old <> _new").select(F.col("_new").alias("_target")).distinct()
    taken = (
        changed[root]
        .where("id IS NOT NULL")
        .groupBy(F.col("id").alias("parent_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
        .join(targets, F.col("parent_key") == F.col("_target"), "left_semi")
    )
    parts = [_blocker(root, "id:changed_twice", twice), _blocker(root, "id:taken", taken)]
    moved = pairs.where("_old <> _new")
    for name in tables:
        for ref in CATALOG[name].references:
            if ref.parent != root:
                continue
            if ref.on_update_cascade:
                changed[name] = _replaced(changed[name], ref.column, pairs)
                continue
            used = tables[name].groupBy(F.col(ref.column).alias("parent_key")).agg(
                F.count(F.lit(1)).alias("row_count")
            )
            held = used.join(moved, F.col("parent_key") == F.col("_old"), "left_semi")
            parts.append(_blocker(name, ref.column, held))
    return KeyChange(changed, reduce(DataFrame.unionByName, parts))
