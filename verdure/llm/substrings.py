"""Substring dedup over a compacted de Bruijn graph of token k-mers.

Every window of ``window`` words belongs to its smallest k-mer (by hash).
Consecutive windows with the same smallest k-mer form one edge of the graph: a
run of words around that k-mer. Edges are named by the k-mer; several edges
with one name are parallel (the texts branch there), equal ones are one path.

1. A pass over all texts lists the edges with their source coordinates.
2. A join keeps the k-mers that occur in more than one document.
3. Equal edges compact to one path, judged once, at its smallest document. The
   copies in larger documents are removed whole.
4. Only where a k-mer branches are windows looked at one by one: the source
   coordinates are read again, for one representative of each path.

This groups windows by their smallest k-mer instead of following links between
single k-mers: a k-mer of every word of a corpus, with joins along its paths, is
many times the text, while one edge stands for about twenty windows here.

Words have two hashes that are made apart, one modulo 2**64 and one modulo a
prime; paths and windows are named by one and confirmed by the other, so the
result holds for whole corpora, and no text is compared pairwise.

Defined results: NULL texts have no words; the smaller of two documents is the
one with the smaller ``doc_id``, NULL being the largest; rows with one
``doc_id`` never remove words from each other; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.llm.words import (
    mix,
    ranges,
    signed,
    span_hashes,
    split_words,
    text_chunks,
)
from verdure.sources.lineage import cut_lineage, drop_state

WINDOW = 50
KMER = 12
_LAST = (1 << 63) - 1
_EDGES = "id bigint, text_key bigint, start int, n int, kmer bigint, path bigint, check bigint"
_WINDOWS = "id bigint, path bigint, place int, hash bigint, check bigint"


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def _edges(data: np.ndarray, offsets: np.ndarray, window: int, kmer: int):
    """Text index, first window, number of windows, k-mer and two path hashes per edge."""
    words = split_words(data, offsets, checked=True)
    sums, again = words.prefix(0), words.prefix(1)
    places, text = ranges(words.first[:-1], words.last_starts(window))
    if not len(places):
        return None
    grams = np.arange(len(words.hashes) - kmer + 1)
    least = _smallest(mix(span_hashes(sums, grams, grams + kmer)), window - kmer + 1)[places]
    fresh = np.ones(len(places), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(fresh)
    count = np.diff(np.append(begin, len(places)))
    start = places[begin]
    end = start + count + window - 1
    return (
        text[begin],
        start - words.first[text[begin]],
        count,
        least[begin],
        span_hashes(sums, start, end),
        span_hashes(again, start, end, 1),
    )


def _list_edges(window: int, kmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for row, end, data, offsets in text_chunks(batch.column(2)):
                found = _edges(data, offsets, window, kmer)
                if found is None:
                    continue
                text, start, count, least, path, check = found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row:end][text]),
                        pa.array(keys[row:end][text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(signed(least)),
                        pa.array(signed(path)),
                        pa.array(signed(check)),
                    ],
                    ["id", "text_key", "start", "n", "kmer", "path", "check"],
                )

    return run


def _window_hashes(window: int):
    """Hashes of the windows of some edges (arrays of start, n, path) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            edges = batch.column(2)
            for row, end, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets, checked=True)
                part = edges.slice(row, end - row)
                flat = part.flatten()
                text = np.repeat(
                    np.arange(len(part)), np.diff(part.offsets.to_numpy(zero_copy_only=False))
                )
                start, n, path = (
                    flat.field(k).to_numpy(zero_copy_only=False) for k in range(3)
                )
                first = words.first[text] + start
                places, owner = ranges(first, first + n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row:end][text[owner]]),
                        pa.array(path[owner]),
                        pa.array((places - first[owner]).astype(np.int32)),
                        pa.array(
                            signed(span_hashes(words.prefix(0), places, places + window))
                        ),
                        pa.array(
                            signed(span_hashes(words.prefix(1), places, places + window, 1))
                        ),
                    ],
                    ["id", "path", "place", "hash", "check"],
                )

    return run


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("id"),
        F.xxhash64("text").alias("text_key"),
        "text",
    )


def repeated_windows(
    documents: DataFrame, window: int = WINDOW, kmer: int = KMER
) -> DataFrame:
    """``id, text_key, removed``: runs of window starts that a smaller document has too."""
    keyed = _keyed(documents)
    edges = cut_lineage(keyed.drop("doc_id").mapInArrow(_list_edges(window, kmer), _EDGES))
    shared = (
        edges.groupBy("kmer")
        .agg(
            F.min("id").alias("low"),
            F.max("id").alias("high"),
            (F.min("path") != F.max("path")).alias("branches"),
        )
        .where("low < high")
        .select("kmer", "branches")
    )
    repeated = cut_lineage(edges.join(shared, "kmer"))
    drop_state(edges)
    owner = F.min(F.struct("id", "text_key", "start", "n")).alias("own")
    paths = cut_lineage(
        repeated.groupBy("kmer", "path", "check").agg(owner, F.first("branches").alias("branches"))
    )

    # One place of each path that has parallel paths: its windows one by one.
    sources = (
        paths.where("branches")
        .select("own.*", "path")
        .groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("start", "n", "path")).alias("edges"))
    )
    windows = cut_lineage(
        keyed.dropDuplicates(["id", "text_key"])
        .join(sources, ["id", "text_key"])
        .select("id", "text", "edges")
        .mapInArrow(_window_hashes(window), _WINDOWS)
    )
    lowest = (
        windows.groupBy("hash", "check")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("hash", "check", "low")
    )
    partly = (
        windows.join(lowest, ["hash", "check"])
        .where("low < id")
        .groupBy("path", "id")
        .agg(F.collect_list("place").alias("places"))
        .withColumnRenamed("id", "own_id")
    )
    verdict = paths.select("kmer", "path", "check", F.col("own.id").alias("own_id")).join(
        partly, ["path", "own_id"], "left"
    )
    whole = F.array(F.struct("start", "n"))
    single = F.transform(
        "places", lambda p: F.struct((F.col("start") + p).alias("start"), F.lit(1).alias("n"))
    )
    removed = F.when(F.col("id") > F.col("own_id"), whole).when(
        F.col("places").isNotNull(), single
    )
    return (
        repeated.join(verdict, ["kmer", "path", "check"])
        .select("id", "text_key", removed.alias("removed"))
        .where("removed IS NOT NULL")
        .groupBy("id", "text_key")
        .agg(F.flatten(F.collect_list("removed")).alias("removed"))
    )


def _kept_words(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = batch.column(2)
            for row, end, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                part = removed.slice(row, end - row)
                flat = part.flatten()
                text = np.repeat(
                    np.arange(len(part)),
                    np.diff(part.offsets.to_numpy(zero_copy_only=False)),
                )
                first = words.first[text] + flat.field(0).to_numpy(zero_copy_only=False)
                change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
                np.add.at(change, first, 1)
                stop = first + flat.field(1).to_numpy(zero_copy_only=False) + window - 1
                np.add.at(change, stop, -1)
                keep = np.cumsum(change)[:-1] == 0
                # Each kept word with one blank after it, cut out of one array.
                size = words.ends - words.starts
                spaced = np.zeros(int(size.sum()) + len(size), dtype=np.uint8)
                at, owner = ranges(words.starts, words.ends)
                spaced[np.arange(len(at)) + owner] = data[at]
                begin = np.cumsum(size + 1) - size - 1
                spaced[begin + size] = 32
                kept = spaced[np.repeat(keep, size + 1)].tobytes()
                held = np.append(0, np.cumsum(np.where(keep, size + 1, 0)))[words.first]
                texts = [
                    kept[held[i] : max(held[i], held[i + 1] - 1)] for i in range(end - row)
                ]
                total = np.diff(words.first)
                left = np.diff(np.append(0, np.cumsum(keep))[words.first])
                columns = [
                    batch.column(0).slice(row, end - row),
                    pa.array(total),
                    pa.array(total - left),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode() for t in texts]))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, kmer: int = KMER, with_text: bool = False
) -> DataFrame:
    """Per document the words left after its repeated windows are taken out."""
    found = repeated_windows(documents, window, kmer)
    none = F.array().cast("array<struct<start:int,n:int>>")
    rows = _keyed(documents).join(found, ["id", "text_key"], "left").select(
        "doc_id", "text", F.coalesce("removed", none).alias("removed")
    )
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if with_text:
        schema += ", kept_text string"
    return rows.mapInArrow(_kept_words(window, with_text), schema)
