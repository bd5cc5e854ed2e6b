"""Admission of order lines against stock, for all products at once.

Lines carry ``id`` (a unique whole number that gives their order),
``id_flower`` and ``amount``; stock carries ``id_flower`` and ``available``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.functions.columns import refusal
from verdure.operators.joins import join_by_key
from verdure.operators.ranking import running_total
from verdure.sources.lineage import cut_lineage

# A product with more lines than this is never handled by one task.
TASK_LINES = 1 << 20


def check_running_demand(lines: DataFrame, stock: DataFrame, ranges: int | None = None) -> DataFrame:
    """Check the lines as one insert: each sees the stock less all lines before it.

    Adds ``available`` (what the line finds), ``ok`` and ``message`` (NULL for
    accepted lines). A product without stock has 0.
    """
    supply = stock.select("id_flower", F.col("available").alias("_change"))
    taken = lines.withColumn("_change", -F.col("amount").cast("bigint"))
    left = running_total(taken, "id_flower", "id", "_change", "_left", supply, ranges)
    found = F.col("_left") + F.coalesce("amount", F.lit(0))
    return (
        left.withColumn("available", found.cast("bigint"))
        .withColumn("ok", F.col("amount") <= F.col("available"))
        .withColumn("message", F.when(~F.col("ok"), refusal(F.col("amount"), F.col("available"))))
        .drop("_change", "_left")
    )


def require_accepted(checked: DataFrame) -> DataFrame:
    """The lines as they came, failing the job at the first refused one.

    The failure is in a filter, so it does not depend on the columns that are
    read afterwards.
    """
    reason = F.coalesce("message", F.lit("a line without an amount cannot be checked"))
    passed = F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean"))
    return checked.where(passed).drop("available", "ok", "message")


def admit_one_by_one(
    lines: DataFrame, stock: DataFrame, task_lines: int = TASK_LINES, ranges: int | None = None
) -> DataFrame:
    """Admit the lines one after another; a refused line uses no stock.

    Adds ``accepted``. Products of ordinary size are sorted and decided many per
    task, see ``first_fit``. A product with more than ``task_lines`` lines is
    spread over the cluster and resolved in rounds, see ``_resolve_large``. An
    amount that is NULL or not positive breaks the rules of the table and is
    refused.
    """
    lines = cut_lineage(lines)
    # At most one product per `task_lines` lines.
    big = (
        lines.groupBy(F.col("id_flower").alias("_product"))
        .agg(F.count(F.lit(1)).alias("_lines"), F.max("amount").alias("_largest"))
        .where((F.col("_lines") > task_lines) & F.col("_product").isNotNull())
        .drop("_lines")
        .collect()
    )
    if not big:
        return _fold_in_order(lines, stock)
    kinds = [lines.schema[c].dataType.simpleString() for c in ("id_flower", "amount")]
    products = lines.sparkSession.createDataFrame(big, f"_product {kinds[0]}, _largest {kinds[1]}")
    is_big = F.col("id_flower") == F.col("_product")
    supply = stock.join(F.broadcast(products), is_big)
    supply = cut_lineage(supply.select("_product", "_largest", F.col("available").alias("_supply")))
    rest = lines.join(F.broadcast(products), is_big, "left_anti")
    large = lines.join(F.broadcast(products), is_big, "left_semi")
    return _fold_in_order(rest, stock).unionByName(
        _resolve_large(cut_lineage(large), supply.where("_supply > 0 AND _largest > 0"), ranges)
    )


def first_fit():
    """A function that admits the runs of a sorted partition, batch by batch.

    It takes run numbers (0, 1, … in the order of the rows), amounts (at most 0
    where a row cannot be admitted) and the stock of each run, and returns which
    rows fit, and what each run has left. All runs are looked at together, in
    phases of constant magnitude of the stock left, see ``_resolve_large``: no
    more phases than the largest amount has binary digits, and one, whatever the
    number of rows.
    """

    # Nested, so that it travels by value and workers need not have the package.
    def decide(run, amount, left):
        import numpy as np

        powers = 1 << np.arange(62, dtype=np.int64)
        digits = lambda x: np.searchsorted(powers, x, side="right")
        accepted = np.zeros(len(run), dtype=bool)
        left = left.copy()
        live = np.flatnonzero(amount > 0)
        top = np.zeros(len(left), dtype=np.int64)
        np.maximum.at(top, run, digits(amount) + 1)
        while True:
            # The stock only falls: what exceeds it now never fits.
            live = live[amount[live] <= left[run[live]]]
            if not len(live):
                return accepted, left
            own, wanted = run[live], amount[live]
            level = np.minimum(digits(left[own]), top[own])
            small = digits(wanted) < level
            total = np.cumsum(np.where(small, wanted, 0))
            begin = np.flatnonzero(np.diff(own, prepend=-1))
            before = np.append(0, total)[begin]
            total -= np.repeat(before, np.diff(np.append(begin, len(own))))
            rest = left[own] - total
            taken = ~small & (wanted <= rest)
            ends = np.flatnonzero(taken | (digits(rest) < level))
            ending, where = np.unique(own[ends], return_index=True)
            stop = np.full(len(left), len(live))
            stop[ending] = ends[where]
            place = np.arange(len(live))
            fits = (small & (place <= stop[own])) | (taken & (place == stop[own]))
            accepted[live[fits]] = True
            np.subtract.at(left, own[fits], wanted[fits])
            live = live[place > stop[own]]

    return decide


def _fold_in_order(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """First-fit over sorted partitions; a product's stock comes in as a row before its lines."""
    decide = first_fit()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, carried = object(), 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            runs = pc.run_end_encode(batch.column("id_flower"))
            sizes = np.diff(runs.run_ends.to_numpy().astype(np.int64), prepend=0)
            own = np.repeat(np.arange(len(sizes)), sizes)
            supply = pc.fill_null(batch.column("_supply"), 0).to_numpy()
            opening = batch.column("_opening").to_numpy(zero_copy_only=False)
            left = np.zeros(len(sizes), dtype=np.int64)
            np.add.at(left, own[opening], supply[opening])
            if runs.values[0].as_py() == last:
                left[0] += carried
            amount = pc.fill_null(batch.column("amount").cast(pa.int64()), 0).to_numpy()
            accepted, left = decide(own, np.where(opening, 0, amount), left)
            last, carried = runs.values[-1].as_py(), int(left[-1])
            kept = pa.array(~opening)
            names = [n for n in batch.schema.names if n not in ("_supply", "_opening")]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(accepted)], [*names, "accepted"]).filter(kept)

    opening = stock.where("available > 0").select(
        F.col("id_flower").cast(lines.schema["id_flower"].dataType).alias("id_flower"),
        F.col("available").cast("bigint").alias("_supply"),
        F.lit(True).alias("_opening"),
    )
    ordered = (
        lines.withColumn("_opening", F.lit(False))
        .unionByName(opening, allowMissingColumns=True)
        .repartition("id_flower")
        .sortWithinPartitions("id_flower", F.desc("_opening"), "id")
    )
    schema = T.StructType([*lines.schema.fields, T.StructField("accepted", T.BooleanType())])
    return ordered.mapInArrow(run, schema)


def _magnitude(value: Column) -> Column:
    """Number of binary digits: m where 2**(m-1) <= value < 2**m; 0 for 0."""
    return F.when(value > 0, F.length(F.bin(value.cast("bigint")))).otherwise(0)


def _resolve_large(lines: DataFrame, products: DataFrame, ranges: int | None) -> DataFrame:
    """One-by-one admission of products whose lines do not fit one task.

    Compare magnitudes (binary digits) of the remaining stock and of a line.
    While the stock keeps its magnitude, a line of smaller magnitude always
    fits and one of larger magnitude never does. A line of equal magnitude
    either does not fit or, if it does, leaves a stock of smaller magnitude.
    So a phase of constant magnitude ends at the first line, in order, that

    * is smaller and pushes the running sum of smaller lines so far that the
      magnitude drops, or
    * has equal magnitude and fits what that running sum has left.

    That line is found for all products together by one running total and one
    minimum. Each round drops the magnitude. A stock far above the largest line
    counts as one digit above it, so there are at most as many rounds as the
    largest line has digits, and one more. A round reads only the lines that
    still can fit. The phases, a few per product, then decide every line.
    """
    lines = lines.withColumn("_digits", _magnitude(F.col("amount")))
    state = products.select(
        "_product",
        F.lit(None).cast("bigint").alias("_after"),
        F.col("_supply").cast("bigint").alias("_left"),
        (_magnitude(F.col("_largest")) + 1).alias("_top"),
    )
    phases = None
    while True:
        state = state.withColumn("_level", F.least(_magnitude(F.col("_left")), "_top"))
        ends = cut_lineage(_phase_ends(lines, state, ranges))
        phases = ends if phases is None else phases.unionByName(ends)
        state = ends.where("_end IS NOT NULL AND _rest > 0").select(
            "_product", F.col("_end").alias("_after"), F.col("_rest").alias("_left"), "_top"
        )
        if state.isEmpty():
            break
    timeline = phases.groupBy("_product").agg(
        F.collect_list(F.struct("_after", "_end", "_level", "_taken")).alias("_phases")
    )
    inside = F.exists(
        "_phases",
        lambda p: (p["_after"].isNull() | (F.col("id") > p["_after"]))
        & (p["_end"].isNull() | (F.col("id") <= p["_end"]))
        & ((F.col("_digits") < p["_level"]) | (p["_taken"] & (F.col("id") == p["_end"]))),
    )
    return (
        join_by_key(lines, "id_flower", timeline, "_product", "left", ["id"])
        .withColumn("accepted", F.coalesce(inside & (F.col("amount") > 0), F.lit(False)))
        .drop("_product", "_phases", "_digits")
    )


def _phase_ends(lines: DataFrame, state: DataFrame, ranges: int | None) -> DataFrame:
    """For each product in ``state`` the line that ends its current phase, if any."""
    still = (
        lines.join(state, F.col("id_flower") == F.col("_product"))
        .where("amount > 0 AND amount <= _left AND (_after IS NULL OR id > _after)")
        .select("_product", "id", "amount", "_left", "_level", "_digits")
        .withColumn("_small", F.when(F.col("_digits") < F.col("_level"), F.col("amount")).otherwise(0))
    )
    summed = running_total(still, "_product", "id", "_small", "_sum", ranges=ranges)
    rest = F.col("_left") - F.col("_sum")
    taken = (F.col("_digits") == F.col("_level")) & (F.col("amount") <= rest)
    dropped = _magnitude(rest) < F.col("_level")
    first = (
        summed.where(taken | dropped)
        .groupBy(F.col("_product").alias("_ended"))
        .agg(
            F.min_by(
                F.struct(
                    F.col("id").alias("end"),
                    F.when(taken, rest - F.col("amount")).otherwise(rest).alias("rest"),
                    taken.alias("taken"),
                ),
                "id",
            ).alias("_first")
        )
    )
    return state.join(first, F.col("_product") == F.col("_ended"), "left").select(
        "_product",
        "_after",
        "_level",
        "_top",
        F.col("_first.end").cast("bigint").alias("_end"),
        F.col("_first.rest").cast("bigint").alias("_rest"),
        F.coalesce("_first.taken", F.lit(False)).alias("_taken"),
    )
