"""Stock admission on a stream of order lines.

Each micro-batch is admitted as a whole, in the order of the line ids, against
what earlier batches left; ``stock`` is what there was before the first batch.
There are two ways:

* ``keyed_admission`` keeps what each product has left in the state store, under
  groups of products. A batch touches the groups of its lines and nothing else.
  The lines of one product in one batch go to one task.
* ``admission_stream`` decides a batch with the batch operator, which spreads
  the lines of one product over the cluster, and keeps its outcome in two
  folders with one partition per batch: ``decided``, the lines, parted by
  ``accepted``, and ``used``, the units that the batch took per product. A batch
  reads what earlier ones took of its own products and overwrites only its own
  partitions, so a repeated batch gives the same result once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from verdure.operators.admission import admit_one_by_one, first_fit
from verdure.sources.lineage import cut_lineage, drop_state

_USED = "id_flower bigint, units bigint"
# Groups of products in the state store. Fixed, as a checkpoint is read again under the same ones.
STATE_GROUPS = 4096
# Not with an underscore first: rows reach pandas as named tuples.
_GROUP, _ABSENT = "product_group", "absent_"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _opening(stock: DataFrame) -> DataFrame:
    return stock.groupBy("id_flower").agg(F.sum(F.col("available").cast("bigint")).alias("available"))


def keyed_admission(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """A stream of the lines with ``accepted``, first fit over the stock left of each product.

    What the products have left is state, in the state store under the group that
    a hash puts a product in; the opening stock goes in with the first batch. The
    lines of a group in one batch are sorted by product and id and decided
    together, by phases and not one by one, so a batch costs a call to Python per
    group and not per product. One task holds them, so the sources' limits on a
    batch (files or bytes per trigger) bound what a hot product asks of it.
    """
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kind = lines.schema["id_flower"].dataType
    initial = _opening(stock).select(F.col("id_flower").cast(kind).alias("id_flower"), "available")
    schema = _grouped(lines).schema
    decided = _grouped(lines).groupBy(_GROUP).transformWithStateInPandas(
        _stock_left(kind.simpleString()),
        T.StructType([*schema.fields, T.StructField("accepted", T.BooleanType())]),
        "Append",
        "None",
        _grouped(initial).groupBy(_GROUP),
    )
    absent = lambda c: F.when(~F.col(_ABSENT + c), F.col(c)).alias(c)
    columns = [absent(c) if _ABSENT + c in schema.names else F.col(c) for c in lines.columns]
    return decided.select(*columns, "accepted")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows with the group of their product.

    A NULL would turn a column of whole numbers into floats on the way to
    pandas, so those have 0 in its place and a flag beside it.
    """
    columns = []
    for field in rows.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            columns.append(F.coalesce(value, F.lit(0).cast(field.dataType)).alias(field.name))
            columns.append(value.isNull().alias(_ABSENT + field.name))
        else:
            columns.append(value)
    group = F.pmod(F.xxhash64("id_flower"), F.lit(STATE_GROUPS)).cast("int").alias(_GROUP)
    return rows.select(group, *columns)


def _stock_left(kind: str):
    from pyspark.sql.streaming import StatefulProcessor

    decide, absent = first_fit(), _ABSENT

    # Nested, so that it travels by value and workers need not have the package.
    class StockLeft(StatefulProcessor):
        def init(self, handle) -> None:
            self.left = handle.getValueState("left", f"products array<{kind}>, units array<bigint>")

        def _units(self) -> dict:
            return dict(zip(*self.left.get(), strict=True)) if self.left.exists() else {}

        def _keep(self, units: dict) -> None:
            self.left.update((list(units), list(units.values())))

        def _products(self, rows):
            """The number of each row's product, and the products; NULL is one of them."""
            import pandas as pd

            column = rows["id_flower"]
            missing = rows[absent + "id_flower"] if absent + "id_flower" in rows else column.isna()
            if missing.any():
                column = column.astype(object).mask(missing.astype(bool), None)
            codes, products = pd.factorize(column, use_na_sentinel=True)
            return codes, products.tolist()

        def handleInitialState(self, key, initialState, timerValues) -> None:
            units = self._units()
            codes, products = self._products(initialState)
            for code, available in zip(codes, initialState["available"].tolist(), strict=True):
                product = products[code] if code >= 0 else None
                units[product] = units.get(product, 0) + available
            self._keep(units)

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            part = pd.concat(list(rows), ignore_index=True)
            codes, products = self._products(part)
            # NULL, if there, is the last product.
            codes = np.where(codes < 0, len(products), codes)
            products = [*products, None][: int(codes.max()) + 1]
            # Lines without an id come last.
            unnumbered = part[absent + "id"].to_numpy(dtype=bool)
            order = np.lexsort((part["id"].to_numpy(), unnumbered, codes))
            part, run = part.iloc[order], codes[order]
            amount = part["amount"].to_numpy().astype(np.int64)
            units = self._units()
            before = np.array([units.get(p, 0) for p in products], dtype=np.int64)
            accepted, left = decide(run, amount, before)
            if accepted.any():
                units.update((products[i], int(left[i])) for i in np.flatnonzero(left != before))
                self._keep(units)
            yield part.assign(accepted=accepted)

        def close(self) -> None:
            pass

    return StockLeft()


def keyed_admission_stream(lines: DataFrame, stock: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Writer of ``keyed_admission`` into Parquet files, each line once; set a trigger and start it."""
    decided = keyed_admission(lines, stock)
    writer = decided.writeStream.outputMode("append").format("parquet")
    return writer.option("path", folder).option("checkpointLocation", checkpoint)


def _used_before(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """Units that earlier batches took, one row per product and batch."""
    if batch == 0:
        return spark.createDataFrame([], _USED)
    used = spark.read.schema(f"{_USED}, batch int").parquet(f"{folder}/used")
    return used.where(F.col("batch") < batch).drop("batch")


def admit_batch(
    stock: DataFrame,
    folder: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that decides the lines of one micro-batch."""

    def decide(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        lines = cut_lineage(prepare(batch) if prepare else batch)
        taken = _used_before(spark, folder, number).select("id_flower", (-F.col("units")).alias("available"))
        wanted = lines.select(F.col("id_flower").alias("_wanted")).distinct()
        left = (
            stock.select("id_flower", F.col("available").cast("bigint").alias("available"))
            .unionByName(taken)
            .join(wanted, F.col("id_flower") == F.col("_wanted"), "left_semi")
            .groupBy("id_flower")
            .agg(F.sum("available").alias("available"))
        )
        # The decisions are written first; everything after reads them back, so
        # the lines are decided once.
        decided_path = f"{folder}/decided/batch={number}"
        decided = admit_one_by_one(lines, left)
        writer = decided.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("accepted").parquet(decided_path)
        drop_state(lines)
        accepted = spark.read.schema(decided.schema).parquet(decided_path).where("accepted")
        (
            accepted.groupBy(F.col("id_flower").cast("bigint").alias("id_flower"))
            .agg(F.sum(F.col("amount").cast("bigint")).alias("units"))
            .write.mode("overwrite")
            .parquet(f"{folder}/used/batch={number}")
        )

    return decide


def admission_stream(
    lines: DataFrame,
    stock: DataFrame,
    folder: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Writer that admits a stream of lines; set a trigger and start it.

    The opening stock is worked out and written here, once; the batches read it.
    """
    stock = cut_lineage(_opening(stock))
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        admit_batch(stock, folder, prepare)
    )


def decided_lines(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All lines decided so far by ``admission_stream``, with ``batch`` and ``accepted``."""
    return spark.read.schema(f"{schema}, batch int, accepted boolean").parquet(f"{folder}/decided")
