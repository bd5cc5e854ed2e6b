"""Surrogate ids, dense ranks and column defaults for new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions.periods import AsOf, as_of_date
from verdure.sources.catalog import TODAY, Relation
from verdure.sources.lineage import cut_lineage

_SLOT, _ORIGIN = "_slot", "_origin"


def assign_ids(
    df: DataFrame,
    order_by: list[str | Column],
    start: int = 1,
    into: str = "id",
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start + 1, …`` in the order given.

    The order must be total for the numbers to be reproducible. Rows are range
    partitioned by it, so no task sees more than its range. Rows that the order
    does not tell apart are ordered by the partition they come from; many
    copies of one row are therefore spread over the ranges as well. The
    position inside a range comes from the slot number (range number in the
    high bits, row number in the low 33). Only the row counts of the ranges,
    one row each, are brought together.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order_by, _ORIGIN]
    placed = df.withColumn(_ORIGIN, F.spark_partition_id())
    ranged = placed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    slotted = cut_lineage(
        ranged.drop(_ORIGIN).withColumn(_SLOT, F.monotonically_increasing_id())
    )
    part = F.shiftright(_SLOT, 33)
    place = F.col(_SLOT).bitwiseAND((1 << 33) - 1)
    rows, last = F.count(F.lit(1)), F.max(place) + 1
    too_many = F.raise_error(F.lit("a range has more rows than a slot number can hold"))
    sizes = slotted.groupBy(part.alias("_part")).agg(
        F.when(rows == last, last).otherwise(too_many.cast("bigint")).alias("_rows")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    # One offset per range: at most `partitions` rows are broadcast.
    return (
        slotted.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(into, F.col("_before") + place + F.lit(start))
        .drop("_part", "_before", _SLOT)
    )


def next_id(existing: DataFrame, column: str = "id") -> int:
    """First free number after the largest id in use; 1 for an empty table."""
    last = existing.agg(F.max(column).alias("last")).first()["last"]
    return 1 if last is None else last + 1


def dense_ranks(df: DataFrame, value: str, into: str = "rank", highest: bool = False) -> DataFrame:
    """Dense rank over all rows without bringing them into one task.

    The distinct values are numbered range by range and joined back. NULL
    counts as the highest value.
    """
    order = F.desc_nulls_first("_level") if highest else F.asc_nulls_last("_level")
    values = df.select(F.col(value).alias("_level")).distinct()
    levels = assign_ids(values, [order], into=into)
    ranked = levels.withColumn(into, F.col(into).cast("int"))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_level"))).drop("_level")


def default_expression(default: str, as_of: AsOf = None) -> Column:
    return as_of_date(as_of) if default == TODAY else F.expr(default)


def fill_defaults(df: DataFrame, relation: Relation, as_of: AsOf = None) -> DataFrame:
    """Add the columns that are absent; those present stay as they are, NULLs too."""
    columns = []
    for field in relation.fields:
        if field.name in df.columns:
            columns.append(F.col(field.name))
            continue
        absent = F.lit(None)
        if field.default is not None:
            absent = default_expression(field.default, as_of)
        columns.append(absent.cast(field.type).alias(field.name))
    return df.select(*columns)
