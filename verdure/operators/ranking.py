"""Best rows with ties, and running totals that do not gather a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.sources.lineage import cut_lineage

_KIND, _VALUE, _RANGE, _INSIDE = "_kind", "_value", "_range", "_inside"


def extreme_rows(df: DataFrame, value: str, highest: bool) -> DataFrame:
    """Rows of dense rank 1 by ``value``, ties included.

    The extreme is a scalar subquery, so the ties, however many, never meet in
    one task as they would under a rank over all rows.
    """
    pick = F.max if highest else F.min
    return df.where(F.col(value) == df.agg(pick(value).alias("extreme")).scalar())


def running_total(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    into: str,
    opening: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Running sum of the whole numbers ``value`` per key, in the order of a unique column.

    A prefix sum by position: rows are range partitioned by key and order, so a
    key that owns most of the table lies in many neighbouring ranges, and each
    task adds up its own sorted range. A key goes on from one range into the
    next only where it is the last of one and the first of the other. So one
    row per range, its first and last key and what the last one adds up to, is
    all that is brought together, and one offset per range is broadcast.

    ``opening`` (``key``, ``value``, at most one row per key) comes before all
    rows of its key. It travels in the same partitioning, as a row that
    sorts first, so nothing is joined. NULL counts as 0, a NULL key is a key
    like others. ``ranges`` defaults to the number of shuffle partitions.
    """
    spark = df.sparkSession
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({_KIND: F.lit(1), _VALUE: F.coalesce(F.col(value).cast("bigint"), F.lit(0))})
    if opening is not None:
        first = opening.select(
            F.col(key).cast(df.schema[key].dataType).alias(key),
            F.lit(0).alias(_KIND),
            F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias(_VALUE),
        )
        rows = rows.unionByName(first, allowMissingColumns=True)
    place = [key, _KIND, order]
    ranged = rows.repartitionByRange(ranges, *place).sortWithinPartitions(*place)
    ranged = ranged.withColumn(_RANGE, F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField(_INSIDE, T.LongType())])
    summed = cut_lineage(ranged.mapInArrow(_sums_of_runs(key), schema))
    return (
        _with_offsets(summed, key, order)
        .where(F.col(_KIND) == 1)
        .withColumn(into, F.col(_INSIDE))
        .drop(_KIND, _VALUE, _RANGE, _INSIDE)
    )


def _sums_of_runs(key: str):
    """Adds running sums over the runs of equal keys in a sorted partition."""

    # Nested, so that it travels by value and workers need not have the package.
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, carried = object(), 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            runs = pc.run_end_encode(batch.column(key))
            ends = runs.run_ends.to_numpy().astype(np.int64)
            total = np.cumsum(batch.column(_VALUE).to_numpy())
            before = np.append(0, total[ends[:-1] - 1])
            if runs.values[0].as_py() == last:
                before[0] -= carried
            inside = total - np.repeat(before, np.diff(ends, prepend=0))
            last, carried = runs.values[-1].as_py(), int(inside[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(inside)], [*batch.schema.names, _INSIDE]
            )

    return run


def _with_offsets(summed: DataFrame, key: str, order: str) -> DataFrame:
    """Adds to a range's first key what it has in the ranges before."""
    place = F.struct(F.col(key).alias("key"), F.col(_KIND), F.col(order))
    # One row per range.
    ranges = (
        summed.groupBy(_RANGE)
        .agg(F.min(place)["key"].alias("first"), F.max(place)["key"].alias("last"), F.max_by(_INSIDE, place).alias("tail"))
        .collect()
    )
    offsets, last, carried = [], object(), 0
    for r in sorted(ranges, key=lambda r: r[_RANGE]):
        before = carried if r["first"] == last else 0
        if before:
            offsets.append((r[_RANGE], r["first"], before))
        carried = r["tail"] + (before if r["first"] == r["last"] else 0)
        last = r["last"]
    kind = summed.schema[key].dataType.simpleString()
    given = summed.sparkSession.createDataFrame(offsets, f"_of int, _first {kind}, _before bigint")
    same = (F.col(_RANGE) == F.col("_of")) & F.col(key).eqNullSafe(F.col("_first"))
    return (
        summed.join(F.broadcast(given), same, "left")
        .withColumn(_INSIDE, F.col(_INSIDE) + F.coalesce("_before", F.lit(0)))
        .drop("_of", "_first", "_before")
    )
