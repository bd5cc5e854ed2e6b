"""Document quality by votes of the nearest labelled documents in a latent space.

A text's terms are its words and pairs of words, hashed into ``WORDS`` counts that
are damped and weighted by how rare the term is among the documents of the whole
corpus, pairs of neighbouring character classes, and measures of repetition and
shape. Labelled documents of a bounded sample span the latent semantic space:
the leading singular vectors of the weighted words, and those of the
standardised rest. The labelled vectors are broadcast (``2 * SAMPLE`` rows of
``RANK + WORD_RANK`` numbers at most); every document is held against all of them
by exact cosine products, block by block, and its nearest ``NEIGHBOURS`` vote with
their similarity, each class weighted as it occurs in the corpus.

Document frequencies are summed in the tasks, one row for each of the ``WORDS``
terms and task. The terms of the sample are made in tasks and only they come
together, as numbers of fixed width, in one task that fits the model; no text
reaches the driver.

Defined results: NULL and empty texts have the vector of no text and are scored
like any other; repeated rows get equal scores; without labels of both kinds the
score is the share of label 1 (0 without labels). Other columns do not matter.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.llm.labelled import SAMPLE, held_out, sample_rows
from verdure.llm.words import mix, split_words, text_chunks

THRESHOLD = 0.7
RANK = 48
#: Hashed words and word pairs, and the latent dimensions that they get.
WORDS, WORD_RANK = 2048, 16
#: Length of the word part of a vector beside that of the rest, 1.
WORD_SHARE = 1.0
NEIGHBOURS = 31
#: Documents whose products with all labelled vectors are held at once.
BLOCK = 512
#: Power of the similarity in a vote.
SHARPNESS = 4
_MARKS = ".,!?#$%&*|-@:/()'\"_=+;<>"
_CLASSES = 32
_CLASS = np.full(256, 1, dtype=np.int64)  # other ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 2, 3, 4
_CLASS[32], _CLASS[10], _CLASS[128:192], _CLASS[192:] = 5, 6, 2, 2
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 7 + _i


@dataclass
class Voter:
    mean: np.ndarray
    axes: np.ndarray  # terms to latent dimensions
    rarity: np.ndarray  # weights of the hashed words
    word_axes: np.ndarray
    word_share: float
    vectors: np.ndarray  # labelled, unit length
    votes: np.ndarray  # 0 or 1 for each of them
    weights: np.ndarray
    constant: float | None = None


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64), first[:-1][full])
    return out


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of terms for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kind = _CLASS[data]
    pairs = np.zeros(0, dtype=np.int64)
    if len(data) > 1:
        same = text[1:] == text[:-1]
        pairs = ((text[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:])[same]
    counts = np.bincount(pairs, minlength=n * _CLASSES**2).reshape(n, _CLASSES**2)
    spectrum = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])

    words = split_words(data, offsets, lower=True)
    lines = split_words(data, offsets, blank=np.arange(256) == 10)
    columns = [np.log1p(size)]
    for cut in (words, lines):
        count = np.maximum(np.diff(cut.first), 1)
        owner = np.repeat(np.arange(n), np.diff(cut.first))
        order = np.lexsort((cut.hashes, owner))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (cut.hashes[order][1:] != cut.hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        columns.append(_per_text(fresh, cut.first) / count)
        again = np.zeros(len(order))
        again[1:] = (cut.hashes[1:] == cut.hashes[:-1]) & (owner[1:] == owner[:-1])
        columns.append(_per_text(again, cut.first) / count)
        length = (cut.ends - cut.starts).astype(np.float64)
        columns.append(np.log1p(_per_text(length, cut.first) / count))
        columns.append(np.log1p(np.diff(cut.first)))
    chars = np.maximum(size, 1)
    for of in (3, 4):
        columns.append(_per_text(kind == of, offsets) / chars)
    columns.append(_per_text((kind == 1) | (kind > 6), offsets) / chars)
    return np.column_stack([spectrum, *columns])


def word_terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed words and pairs of neighbouring words of each text, in ``WORDS`` columns."""
    n = len(offsets) - 1
    words = split_words(data, offsets, lower=True)
    text = np.repeat(np.arange(n), np.diff(words.first))
    one = words.hashes
    same = text[1:] == text[:-1]
    two = mix(one[:-1] * np.uint64(3) + one[1:])[same]
    half = WORDS // 2
    at = np.concatenate(
        [
            text * WORDS + (one % np.uint64(half)).astype(np.int64),
            text[1:][same] * WORDS + half + (two % np.uint64(half)).astype(np.int64),
        ]
    )
    return np.bincount(at, minlength=n * WORDS).reshape(n, WORDS)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Parts of at most ``BLOCK`` rows with the bytes and offsets of their texts."""
    for batch in batches:
        for row, end, data, offsets in text_chunks(batch.column("text")):
            for at in range(0, end - row, BLOCK):
                stop = min(at + BLOCK, end - row)
                yield (
                    batch.slice(row + at, stop - at),
                    data[offsets[at] : offsets[stop]],
                    offsets[at : stop + 1] - offsets[at],
                )


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents that have each hashed word, and all documents (term -1)."""
    held, total = np.zeros(WORDS, dtype=np.int64), 0
    for part, data, offsets in _blocks(batches):
        held += (word_terms(data, offsets) > 0).sum(axis=0)
        total += part.num_rows
    terms = np.append(np.arange(WORDS), -1).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.append(held, total))], ["term", "n"])


def rarities(documents: DataFrame) -> np.ndarray:
    """Weight of each hashed word: the logarithm of how few documents of the corpus have it."""
    counted = (
        documents.select("text")
        .mapInArrow(_count_documents, "term int, n bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    n = {r.term: r.n for r in counted}
    return np.log((1 + n.get(-1, 0)) / (1 + np.array([n.get(k, 0) for k in range(WORDS)])))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def latent(table: np.ndarray, words: np.ndarray, voter: Voter) -> np.ndarray:
    """Vectors of length 1 in the latent space."""
    rest = _unit((table - voter.mean) @ voter.axes)
    said = _unit((np.log1p(words) * voter.rarity) @ voter.word_axes)
    return _unit(np.column_stack([rest, voter.word_share * said]))


def train(
    table: np.ndarray, words: np.ndarray, labels: np.ndarray, sizes: tuple[int, int], rarity: np.ndarray,
    rank: int = RANK, word_share: float = WORD_SHARE,
) -> Voter:
    """A voter from the terms and labels of the sample; ``sizes`` of both classes in the corpus."""
    total = sum(sizes)
    labels = labels.astype(np.float64)
    nothing = np.zeros((0, 1))
    if len(set(labels.tolist())) < 2:
        share = sizes[1] / total if total else 0.0
        return Voter(nothing, nothing, rarity, nothing, word_share, nothing, labels, labels, share)
    mean, spread = table.mean(axis=0), table.std(axis=0)
    scaled = (table - mean) / np.maximum(spread, 1e-3)
    _, strength, axes = np.linalg.svd(scaled, full_matrices=False)
    axes = axes[: min(rank, len(strength))].T / np.maximum(spread, 1e-3)[:, None]
    _, strength, word_axes = np.linalg.svd(np.log1p(words) * rarity, full_matrices=False)
    word_axes = word_axes[: min(WORD_RANK, len(strength))].T
    weights = np.where(labels == 1, sizes[1] / (labels == 1).sum(), sizes[0] / (labels == 0).sum())
    voter = Voter(mean, axes, rarity, word_axes, word_share, nothing, labels, weights)
    voter.vectors = latent(table, words, voter)
    return voter


def vote(table: np.ndarray, words: np.ndarray, voter: Voter, neighbours: int = NEIGHBOURS) -> np.ndarray:
    if voter.constant is not None:
        return np.full(len(table), voter.constant)
    out = np.empty(len(table))
    k = min(neighbours, len(voter.votes))
    for at in range(0, len(table), BLOCK):
        near = latent(table[at : at + BLOCK], words[at : at + BLOCK], voter) @ voter.vectors.T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        power = np.maximum(np.take_along_axis(near, best, axis=1), 1e-6) ** SHARPNESS
        power = power * voter.weights[best]
        out[at : at + BLOCK] = (power * voter.votes[best]).sum(axis=1) / power.sum(axis=1)
    # Products may differ in their last digits from block to block.
    return np.round(out, 6)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter: Voter = shared.value
        for part, data, offsets in _blocks(batches):
            score = vote(terms(data, offsets), word_terms(data, offsets), voter)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    return run


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in _blocks(batches):
        rows = np.column_stack([terms(data, offsets), word_terms(data, offsets)])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["doc_id", "label", "terms"],
        )


def _fit(sizes: tuple[int, int], rarity: np.ndarray, word_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["doc_id"])
        if not rows:
            return
        table = np.array([np.frombuffer(r["terms"]) for r in rows])
        labels = np.array([r["label"] for r in rows])
        model = train(table[:, :-WORDS], table[:, -WORDS:], labels, sizes, rarity, word_share=word_share)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def fit(
    documents: DataFrame, labels: DataFrame, bound: int = SAMPLE, word_share: float = WORD_SHARE
) -> Voter:
    """A voter from at most ``bound`` labelled documents of each class; only it comes to the driver."""
    rows, sizes = sample_rows(documents, labels, "quality", bound)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rarity = rarities(documents)
    made = rows.select("doc_id", "text", "label").mapInArrow(_sample_terms, f"doc_id {kind}, label int, terms binary")
    row = made.repartition(1).mapInArrow(_fit(sizes, rarity, word_share), "model binary").first()
    if row is None:  # An empty sample.
        nothing = np.zeros((0, 1))
        return train(nothing, nothing, np.zeros(0), sizes, rarity)
    return pickle.loads(row["model"])


def score_documents(documents: DataFrame, voter: Voter) -> DataFrame:
    """``documents`` with ``score``, the weighted share of good neighbours."""
    shared = documents.sparkSession.sparkContext.broadcast(voter)
    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(_score(shared), schema)


def quality_report(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    scored = score_documents(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
