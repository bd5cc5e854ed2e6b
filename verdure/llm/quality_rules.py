"""Quality rules: counts of a text, and a log-likelihood ratio of hashed n-grams.

The rules count words, symbols, repeated lines and repeated windows exactly, by
the bytes themselves and not by hashes of them. The ratio holds the n-grams of
``ORDER`` bytes, hashed into ``BUCKETS``, against two multinomials: one of the
trusted target, the labelled good documents, and one of the raw corpus, which is
every document. A text's score is the mean over its n-grams of
``log(target / raw)``; it falls with everything that is rarer in good text
than in the corpus. The threshold is the one that has most of the labelled
documents right, in the middle of the lowest gap between two bins with that many;
every document is held against it in the same way.

Counts are summed per task before the shuffle, at most ``BUCKETS`` rows each;
the driver gets ``BUCKETS`` sums and a histogram of at most ``2 * LEVELS`` bins.
The target is at most ``TRUSTED`` labelled documents outside the held-out fold,
picked by a hash of their id, whose ids are broadcast; the raw corpus and the
threshold know no bound. Logarithms are whole numbers of ``1 / UNIT``, so sums do
not depend on their order.

Defined results: NULL, empty and blank texts have no words and fail. A text of
fewer bytes than ``ORDER`` has the score 0. Repeated rows are counted as often as
they stand and get equal rows. Without good labelled documents the ratio says
nothing and only the rules decide; without bad ones the threshold lets every
labelled one pass. Of repeated labels of one document the largest counts. Only id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.llm.labelled import held_out
from verdure.llm.words import exact_ids, ranges, text_chunks, word_bounds
from verdure.sources.lineage import cut_lineage

ORDER = 3
BUCKETS = 1 << 16
#: Most labelled documents that make up the trusted target.
TRUSTED = 20_000
#: Added to the count of every bucket.
PRIOR = 1.0
#: A score of 1 in the whole numbers of the weights; bins of the threshold, and scores per bin.
UNIT = 1 << 20
LEVELS, LEVEL = 2048, UNIT >> 7
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_NEWLINE = np.arange(256) == 10
_LEAD = np.ones(256, dtype=bool)
_LEAD[128:192] = False


def _within(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marks lie in each ``[bounds[i], bounds[i + 1])``."""
    return np.diff(np.append(0, np.cumsum(marks))[bounds])


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each text in a row, and where each text's begin."""
    sizes = np.maximum(np.diff(offsets) - ORDER + 1, 0)
    if not sizes.sum():
        return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    n = len(data) - ORDER + 1
    value = np.zeros(n, dtype=np.uint32)
    for k in range(ORDER):
        value = value * np.uint32(257) + data[k : n + k]
    value = (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    places, _ = ranges(offsets[:-1], offsets[:-1] + sizes)
    return value[places].astype(np.int64), np.append(0, np.cumsum(sizes))


def repeated_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and those in windows of ``WINDOW`` words that its text has twice or more."""
    starts, ends, first = word_bounds(data, offsets)
    ids, kinds = exact_ids(data, starts, ends)
    count = np.diff(first)
    places, text = ranges(first[:-1], first[1:] - WINDOW + 1)
    if not len(places):
        return count, np.zeros(len(count), dtype=np.int64)
    # Numbers of pairs of neighbouring words; a window is four pairs.
    _, pair, often = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True, return_counts=True)
    pairs = [pair[places + 2 * k] for k in range(WINDOW // 2)]
    may = np.logical_and.reduce([often[p] > 1 for p in pairs])
    places, text, pairs = places[may], text[may], [p[may] for p in pairs]
    order = np.lexsort((*pairs, text))
    same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in (text, *pairs)])
    again = np.zeros(len(order) + 1, dtype=bool)
    again[1:-1] = same if len(order) else again[1:-1]
    hit = places[order[again[:-1] | again[1:]]]
    depth = np.bincount(hit, minlength=len(ids) + 1) - np.bincount(hit + WINDOW, minlength=len(ids) + 1)
    return count, _within(np.cumsum(depth[:-1]) > 0, first)


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line."""
    starts, ends, first = word_bounds(data, offsets, _NEWLINE)
    if not len(starts):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    words = np.append(0, np.cumsum(~_BLANK[data]))
    kept = words[ends] > words[starts]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[kept]
    ids, kinds = exact_ids(data, starts[kept], ends[kept])
    total = np.bincount(text, minlength=len(first) - 1)
    distinct = np.unique(text * max(kinds, 1) + ids) // max(kinds, 1)
    return total - np.bincount(distinct, minlength=len(first) - 1)


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and bucket: n-grams of all documents, and of the trusted ones."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for row, end, data, offsets in text_chunks(batch.column("text")):
            buckets, first = ngrams(data, offsets)
            raw += np.bincount(buckets, minlength=BUCKETS)
            mine = np.repeat(trusted[row:end], np.diff(first))
            target += np.bincount(buckets[mine], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
    )


def _known(labels: DataFrame) -> DataFrame:
    """One label for each labelled document outside the held-out fold."""
    usable = F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    return labels.where(usable).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("_label"))


def ngram_weights(documents: DataFrame, labels: DataFrame, trusted: int = TRUSTED) -> np.ndarray | None:
    """``log(target / raw)`` of every bucket in whole numbers of ``1 / UNIT``; None without a target."""
    chosen = _known(labels).where("_label = 1").orderBy(F.xxhash64("_id"), "_id").limit(trusted)
    marked = documents.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left"
    )
    counts = (
        marked.select("text", F.col("_id").isNotNull().alias("trusted"))
        .mapInArrow(_count_ngrams, "bucket int, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    raw, target = np.full(BUCKETS, PRIOR), np.full(BUCKETS, PRIOR)
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if not any(r.target for r in counts):
        return None
    return np.rint(np.log(target / target.sum() * (raw.sum() / raw)) * UNIT).astype(np.int64)


def _measure(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: np.ndarray | None = shared.value
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column("text")):
                n_words, repeated = repeated_windows(data, offsets)
                buckets, first = ngrams(data, offsets)
                n_grams = np.diff(first)
                total = np.zeros(len(n_words), dtype=np.int64)
                if weights is not None and len(buckets):
                    total = np.diff(np.append(0, np.cumsum(weights[buckets]))[first])
                columns = [
                    n_words,
                    _within(_LEAD[data] & ~_BLANK[data], offsets),
                    _within(_SYMBOL[data], offsets),
                    repeated_lines(data, offsets),
                    repeated,
                    # In whole numbers, rounded down.
                    total // np.maximum(n_grams, 1),
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), *(pa.array(c.astype(np.int64)) for c in columns)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"],
                )

    return run


def measures(documents: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """The counts of the rules and ``ratio``, the score in whole numbers of ``1 / UNIT``."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio")
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    return documents.select("doc_id", "text").mapInArrow(
        _measure(shared), f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names)
    )


def threshold(measured: DataFrame, labels: DataFrame) -> int | None:
    """Lowest ratio that is kept: an edge of a bin; None without good labelled documents.

    Rows of one id in one bin are counted before they travel, so an id has at most
    ``LEVELS`` rows in the join. Neither side is broadcast: files of labels are small
    for the rows they hold.
    """
    level = F.floor(F.col("ratio") / LEVEL).cast("int")
    level = F.greatest(F.least(level, F.lit(LEVELS // 2 - 1)), F.lit(-LEVELS // 2))
    binned = measured.groupBy("doc_id", level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    counted = (
        binned.join(_known(labels).hint("merge"), F.col("doc_id") == F.col("_id"))
        .groupBy("level", "_label")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    good, bad = ({r.level: r.n for r in counted if r._label == label} for label in (1, 0))
    if not good:
        return None
    levels = sorted({*good, *bad})
    right = [
        sum(n for x, n in good.items() if x >= at) + sum(n for x, n in bad.items() if x < at) for at in levels
    ]
    best = right.index(max(right))
    below = levels[best - 1] if best else levels[0] - 1
    at = (below + 1 + levels[best]) // 2
    # The lowest bin also holds all below it.
    return at * LEVEL if at > -LEVELS // 2 else None


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, ``ratio``, ``base_failed`` and ``kept`` of every document."""
    measured = cut_lineage(measures(documents, ngram_weights(documents, labels)))
    least = threshold(measured, labels)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    passes = F.lit(True) if least is None else F.col("ratio") >= least
    return measured.withColumns({"base_failed": failed, "kept": ~failed & passes})


def rules_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_rules(documents, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        (F.col("ratio") / UNIT).alias("score"),
    )
