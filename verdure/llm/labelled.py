"""Bounded samples of labelled documents for training."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled documents of each class that a model is fitted on.
SAMPLE = 1500


def held_out(doc_id: Column) -> Column:
    """The fold whose labels are never learned from; a NULL id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Sample:
    texts: list[str]
    labels: list[int]
    #: Labelled documents outside the held-out fold, of label 0 and label 1.
    sizes: tuple[int, int]


def sample_rows(
    documents: DataFrame, labels: DataFrame, column: str, bound: int = SAMPLE
) -> tuple[DataFrame, tuple[int, int]]:
    """``doc_id, text, label`` of the sample, and the sizes of both classes.

    At most ``bound`` documents of each label, picked by a hash of their id.

    NULL labels are no labels; of repeated labels of one document the largest
    counts. Only ids travel before the bound is met, and at most ``2 * bound``
    of them are broadcast.
    """
    known = (
        labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        known.where(F.col("label") == value)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
        for value in (0, 1)
    ]
    chosen = parts[0].union(parts[1]).select(F.col("doc_id").alias("_id"), "label")
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.first("label").alias("label"))
    )
    return rows, (counts.get(0, 0), counts.get(1, 0))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, column: str, bound: int = SAMPLE
) -> Sample:
    """The sample on the driver."""
    rows, sizes = sample_rows(documents, labels, column, bound)
    return _sample([(r["doc_id"], r["text"], r["label"]) for r in rows.collect()], sizes)


def _sample(rows: list[tuple], sizes: tuple[int, int]) -> Sample:
    rows = sorted(rows, key=lambda r: r[0])
    return Sample([r[1] or "" for r in rows], [r[2] for r in rows], sizes)


def fitted(rows: DataFrame, sizes: tuple[int, int], train: Callable[[Sample], object]) -> object:
    """The model that ``train`` makes of the sample, in one task; only it comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        model = pickle.dumps(train(_sample(held, sizes)))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    made = rows.select("doc_id", "text", "label").repartition(1).mapInArrow(run, "model binary")
    row = made.first()
    # Spark plans no task for an empty sample.
    return train(_sample([], sizes)) if row is None else pickle.loads(row["model"])
