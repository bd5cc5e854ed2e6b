"""Joins whose NULL rules, sizes or hot keys need care."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EMPTY, _PLAIN, _HAS_NULL = 0, 1, 2
SALTS = 8


def join_by_key(
    rows: DataFrame,
    column: str,
    lookup: DataFrame,
    key: str,
    how: str,
    salt_from: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows with hot values of ``column`` to a table that has each ``key`` once.

    Such a table is mostly the result of grouping by the key. Joined as it is,
    it keeps the partitioning of the grouping, and a join with an input that is
    not a shuffle of its own is one whose skew is never split at run time. The
    salt spreads a hot value over ``salts`` tasks and gives both inputs their
    own shuffle, so that what is still too large is split further. A small
    table is broadcast all the same.

    The salt is a hash of the columns ``salt_from``, best a key of the rows; by
    default of all numbers, dates and flags, or of everything if there are none.
    """
    if salt_from is None:
        plain = (T.NumericType, T.DatetimeType, T.TimestampNTZType, T.BooleanType)
        others = [f.name for f in rows.schema if isinstance(f.dataType, plain) and f.name != column]
        salt_from = others or rows.columns
    salted = lookup.withColumn(
        "_lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    same = (F.col(column) == F.col(key)) & (F.col("_salt") == F.col("_lookup_salt"))
    return spread.join(salted, same, how).drop("_salt", "_lookup_salt")


def not_in(
    rows: DataFrame,
    column: str,
    candidates: DataFrame,
    nullable: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Rows for which ``column NOT IN (candidates)`` is true.

    A SQL ``NOT IN`` makes Spark broadcast the candidates whatever their size.
    Here they are reduced to distinct values and shuffled for a plain anti
    join, and the NULL rules are a filter on one scalar:

    * no candidates: every row stays, also one with NULL;
    * a NULL among the candidates: no row stays;
    * otherwise a row with NULL goes.

    ``nullable=False`` leaves the filter out, for columns that are never NULL
    on either side. ``unique=True`` says that no value of ``column`` is hot.
    """
    if len(candidates.columns) != 1:
        raise ValueError("candidates must have exactly one column")
    values = candidates.toDF("_value").distinct()
    if unique:
        kept = rows.join(values, F.col(column) == F.col("_value"), "left_anti")
    else:
        kept = join_by_key(rows, column, values, "_value", "left_anti")
    if not nullable:
        return kept
    state = values.agg(
        F.when(F.count(F.lit(1)) == 0, _EMPTY)
        .when(F.count("_value") == F.count(F.lit(1)), _PLAIN)
        .otherwise(_HAS_NULL)
        .alias("state")
    ).scalar()
    # Highest state in which the row may stay.
    return kept.where(state <= F.when(F.col(column).isNull(), _EMPTY).otherwise(_PLAIN))


def lookup_total(
    rows: DataFrame, column: str, facts: DataFrame, key: str, value: str, into: str
) -> DataFrame:
    """Attach to each row the total of ``value`` over the facts of its key, 0 for none."""
    totals = facts.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias("_total"))
    return (
        join_by_key(rows, column, totals, "_key", "left")
        .withColumn(into, F.coalesce("_total", F.lit(0)))
        .drop("_key", "_total")
    )
