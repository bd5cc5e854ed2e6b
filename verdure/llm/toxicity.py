"""Toxic spans by a linear-chain conditional random field, documents by its marginals.

Words are tagged toxic or other. The features of a word are hashes of itself, of
its beginnings and of its end, lower-cased. Labels exist for documents only, so
labelled tokens are made from them: in documents labelled toxic, a word counts
as toxic if one of its features is found in toxic documents, hardly anywhere else
and far more often than by chance. Near copies in the sample count once. The field is
trained by stochastic gradients of its exact likelihood; the tagger
runs over every word of every text, in sequences of up to ``SEQUENCE`` words.

The two-state forward and backward recursions are kept as odds, which makes
them one number per word. A document's score is a logistic function of the
summed and the largest marginal, fitted to the labels with the classes weighted
as they occur.

Defined results: NULL and wordless texts get the score of a text without any
toxic word; without labels of both kinds every score is the share of label 1
(0 without labels). Other columns do not matter, and repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.llm.labelled import SAMPLE, Sample, fitted, held_out, sample_rows
from verdure.llm.words import (
    byte_prefix,
    mix,
    ranges,
    shingle_sets,
    span_hashes,
    split_words,
    text_chunks,
)

THRESHOLD = 0.3
SEQUENCE = 64
BUCKETS = 1 << 20
#: Bytes of text that are tagged together.
CHUNK = 1 << 19
_BEGINNINGS = (4, 5, 6, 7, 8, 9)
_FEATURES = len(_BEGINNINGS) + 2
#: A feature marks toxic words if this share of the documents that would have it in
#: the corpus are toxic …
PRECISION = 0.8
#: … and chance would give so many of them with a probability below exp(-EVIDENCE).
EVIDENCE = 9.0
_LIMIT = 30.0


@dataclass
class Tagger:
    weights: np.ndarray  # one per feature bucket
    transitions: np.ndarray  # log potentials other-other, other-toxic, toxic-other, toxic-toxic
    calibration: np.ndarray  # of 1, log1p(sum of marginals), largest marginal
    constant: float | None = None


def token_features(data: np.ndarray, offsets: np.ndarray):
    """Words of the texts and the feature buckets of each (rows are words)."""
    words = split_words(data, offsets, lower=True)
    sums = byte_prefix(words.data)
    size = words.ends - words.starts
    table = np.empty((len(size), _FEATURES), dtype=np.int32)

    def fill(column: int, hashes: np.ndarray) -> None:
        table[:, column] = mix(hashes) % np.uint64(BUCKETS)

    fill(0, words.hashes)
    for k, n in enumerate(_BEGINNINGS, 1):
        # A shorter word has no such beginning; its bucket is that of the word.
        cut = span_hashes(sums, words.starts, words.starts + np.minimum(n, size), 1)
        fill(k, np.where(size > n, cut + np.uint64(n), words.hashes))
    tail = span_hashes(sums, words.ends - np.minimum(4, size), words.ends, 1)
    fill(_FEATURES - 1, tail + np.uint64(99))
    return words, table


def sequences(first: np.ndarray, length: int = SEQUENCE) -> np.ndarray:
    """Word positions, one sequence per row, -1 where a row has ended."""
    count = np.diff(first)
    pieces = -(-count // length)
    number, text = ranges(np.zeros(len(count), dtype=np.int64), pieces)
    start = first[text] + number * length
    place = start[:, None] + np.arange(length)[None, :]
    return np.where(place < first[text + 1][:, None], place, -1)


def forward_backward(scores: np.ndarray, inside: np.ndarray, transitions: np.ndarray):
    """Odds of the forward and backward messages for each place of each sequence."""
    oo, ot, to, tt = np.exp(transitions)
    gain = np.exp(np.clip(scores, -_LIMIT, _LIMIT))
    ahead, back = np.empty_like(gain), np.ones_like(gain)
    ahead[:, 0] = gain[:, 0]
    for t in range(1, gain.shape[1]):
        last = ahead[:, t - 1]
        ahead[:, t] = gain[:, t] * (ot + last * tt) / (oo + last * to)
    for t in range(gain.shape[1] - 2, -1, -1):
        later = gain[:, t + 1] * back[:, t + 1]
        back[:, t] = np.where(
            inside[:, t + 1], (to + tt * later) / (oo + ot * later), 1.0
        )
    return gain, ahead, back


def marginals(first: np.ndarray, table: np.ndarray, tagger: Tagger) -> np.ndarray:
    """Probability of each word to be toxic."""
    scores = np.zeros(len(table))
    for k in range(_FEATURES):
        scores += tagger.weights[table[:, k]]
    places = sequences(first)
    inside = places >= 0
    held = np.where(inside, scores[np.maximum(places, 0)] if len(scores) else 0.0, -_LIMIT)
    _, ahead, back = forward_backward(held, inside, tagger.transitions)
    odds = ahead * back
    out = np.empty(len(scores))
    out[places[inside]] = (odds / (1 + odds))[inside]
    return out


def _arrays(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(t) for t in raw])).astype(np.int64)
    return np.frombuffer(b"".join(raw), dtype=np.uint8), offsets


def _sample_features(texts: list[str], step: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Word offsets and features of the sample, made in small parts."""
    total = sum(len(split_words(*_arrays([text])).hashes) for text in texts)
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    held = np.empty((total, _FEATURES), dtype=np.int32)
    for at in range(0, len(texts), step):
        words, table = token_features(*_arrays(texts[at : at + step]))
        begin = first[at]
        first[at + 1 : at + 1 + len(words.first) - 1] = begin + words.first[1:]
        held[begin : begin + len(table)] = table
    return first, held


def different(texts: list[str]) -> list[int]:
    """Indices of texts of which no near copy came before: bottom sketches do not meet."""
    seen: set[int] = set()
    chosen = []
    for i, text in enumerate(texts):
        flat, _ = shingle_sets(split_words(*_arrays([text]), lower=True), 4)
        sketch = set(np.sort(mix(flat))[:4].tolist())
        if not sketch & seen:
            chosen.append(i)
        seen |= sketch
    return chosen


def _evidence(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Chernoff bound of the surprise that ``toxic`` of all documents with a feature are toxic."""
    base = toxic.sum() / max(toxic.sum() + clean.sum(), 1)
    n = np.maximum(toxic + clean, 1)
    part = np.clip(toxic / n, 1e-12, 1 - 1e-12)
    base = min(max(base, 1e-12), 1 - 1e-12)
    away = part * np.log(part / base) + (1 - part) * np.log((1 - part) / (1 - base))
    return np.where(part > base, n * away, 0.0)


def _statistics(chance: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(first) - 1)
    largest = np.zeros(len(total))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(chance, first[:-1][full])
        largest[full] = np.maximum.reduceat(chance, first[:-1][full])
    return np.stack([np.ones(len(total)), np.log1p(total), largest], axis=1)


def logistic(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float = 1e-2):
    """Weighted logistic regression by Newton steps."""
    beta = np.zeros(rows.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(rows @ beta, -_LIMIT, _LIMIT)))
        slope = rows.T @ (weight * (labels - chance)) - ridge * beta
        curve = (rows * (weight * chance * (1 - chance) + 1e-9)[:, None]).T @ rows
        step = np.linalg.solve(curve + ridge * np.eye(len(beta)), slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(sample: Sample, rounds: int = 8, batch: int = 1024, rate: float = 0.5) -> Tagger:
    labels = np.array(sample.labels)
    total = sum(sample.sizes)
    if len(set(sample.labels)) < 2:
        return Tagger(
            np.zeros(BUCKETS), np.zeros(4), np.zeros(3),
            sample.sizes[1] / total if total else 0.0,
        )
    first, table = _sample_features(sample.texts)
    ratio = (sample.sizes[0] / (labels == 0).sum()) / (sample.sizes[1] / (labels == 1).sum())

    lone = set(different(sample.texts))
    counts = []
    for value in (0, 1):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for i in np.flatnonzero(labels == value):
            if i in lone:
                total[np.unique(table[first[i] : first[i + 1]])] += 1
        counts.append(total)
    share = counts[1] / np.maximum(counts[1] + counts[0] * ratio, 1e-9)
    marks = (share >= PRECISION) & (_evidence(*counts) >= EVIDENCE)
    owner = np.repeat(labels, np.diff(first))
    # The end of a word alone marks nothing.
    target = np.zeros(len(table), dtype=bool)
    for k in range(_FEATURES - 1):
        target |= marks[table[:, k]]
    target = (target & (owner == 1)).astype(np.float64)

    places = sequences(first)
    order = np.random.default_rng(1).permutation(len(places))
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    steps = np.array([1.0, -1.0, -1.0, 0.0])
    steps_seen = np.full(4, 1e-6)
    for _ in range(rounds):
        for at in range(0, len(order), batch):
            rows = places[order[at : at + batch]]
            inside = rows >= 0
            held = np.maximum(rows, 0)
            scores = np.where(inside, weights[table[held]].sum(axis=2), -_LIMIT)
            gain, ahead, back = forward_backward(scores, inside, steps)
            odds = ahead * back
            wrong = np.where(inside, target[held] - odds / (1 + odds), 0.0)
            slope = np.bincount(
                table[held[inside]].ravel(),
                weights=np.repeat(wrong[inside], _FEATURES),
                minlength=BUCKETS,
            ) - 1e-3 * weights
            seen += slope**2
            weights += rate * slope / np.sqrt(seen)
            # Expected and observed pairs of neighbours.
            both = inside[:, 1:]
            later = gain[:, 1:] * back[:, 1:]
            chance = np.stack(
                [
                    np.exp(steps[0]) * np.ones_like(later),
                    np.exp(steps[1]) * later,
                    np.exp(steps[2]) * ahead[:, :-1],
                    np.exp(steps[3]) * ahead[:, :-1] * later,
                ]
            )
            chance /= chance.sum(axis=0)
            here, then = target[held[:, :-1]], target[held[:, 1:]]
            real = np.stack([(1 - here) * (1 - then), (1 - here) * then, here * (1 - then), here * then])
            push = ((real - chance) * both).sum(axis=(1, 2))
            steps_seen += push**2
            steps += 0.2 * push / np.sqrt(steps_seen)
    tagger = Tagger(weights, steps, np.zeros(3))
    # Text by text in small parts, as the messages take several numbers per word.
    parts = []
    for at in range(0, len(labels), 100):
        own = first[at : at + 101]
        chance = marginals(own - own[0], table[own[0] : own[-1]], tagger)
        parts.append(_statistics(chance, own - own[0]))
    rows = np.concatenate(parts)
    tagger.weights = weights.astype(np.float32)
    tagger.calibration = logistic(rows, labels, np.where(labels == 1, 1.0, ratio))
    return tagger


def _spans(chance, words, data, row: int, floor: float):
    """Runs of words of one text with marginals of at least ``floor``, in code points."""
    lo, hi = words.first[row], words.first[row + 1]
    hot = np.flatnonzero(chance[lo:hi] >= floor) + lo
    out = []
    for run in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
        if len(run):
            out.append((words.starts[run[0]], words.ends[run[-1]], float(chance[run].max())))
    return out


def _score(shared, floor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger: Tagger = shared.value
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("text"), CHUNK):
                words, table = token_features(data, offsets)
                chance = marginals(words.first, table, tagger)
                rows = _statistics(chance, words.first)
                total = (rows * tagger.calibration).sum(axis=1)
                score = 1 / (1 + np.exp(-np.clip(total, -_LIMIT, _LIMIT)))
                if tagger.constant is not None:
                    score[:] = tagger.constant
                # Bytes that start a code point, counted up to each byte.
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                spans = [
                    [
                        {
                            "start": int(points[a] - points[offsets[i]]),
                            "end": int(points[b] - points[offsets[i]]),
                            "probability": p,
                        }
                        for a, b, p in _spans(chance, words, data, i, floor)
                    ]
                    for i in range(end - row)
                ]
                kind = pa.list_(
                    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
                )
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array(spans, kind)],
                    [*part.schema.names, "score", "spans"],
                )

    return run


def fit(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Tagger:
    rows, sizes = sample_rows(documents, labels, "toxic", bound)
    return fitted(rows, sizes, train)


def score_documents(documents: DataFrame, tagger: Tagger, floor: float = 0.5) -> DataFrame:
    """``documents`` with ``score`` and ``spans`` (code points, end exclusive)."""
    shared = documents.sparkSession.sparkContext.broadcast(tagger)
    span = T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )
    schema = T.StructType(
        [*documents.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]
    )
    return documents.mapInArrow(_score(shared, floor), schema)


def toxicity_report(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    scored = score_documents(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents below the threshold, with all their columns."""
    tagger = fit(documents, labels)
    names = documents.columns
    plain = documents.select(F.struct(*names).alias("row"), "text")
    return score_documents(plain, tagger).where(F.col("score") < threshold).select("row.*")
