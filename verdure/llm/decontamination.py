"""Benchmark decontamination: test n-grams in a broadcast hash set, DataFrame operations only.

Words are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII
characters. A window is ``n`` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window. Every whole document is scanned: its
words are hashed once; a bitmap of fixed size, probed with three words of each
window, passes the places worth a closer look; their full window hashes meet
the set of test windows in a hash join. A hit is verified by a second hash over
the same words with another seed (128 bits together).

Defined results: NULL or wordless texts have no words and no hits; repeated
rows each get their own result; a NULL ``doc_id`` is an id like any other; an
empty benchmark hits nothing; other columns do not take part and cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.sources.lineage import cut_lineage

N = 10
#: Largest benchmark, in windows, that is broadcast; a larger one is shuffled.
BROADCAST_WINDOWS = 2_000_000
#: Size of the bitmap that is probed first: 2**14 longs, 128 KB at any scale.
BITMAP_LONGS = 1 << 14
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEED = 20_261_201


def normal_words(text: Column) -> Column:
    """Array of the normalised words; empty for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(plain, _SEPARATORS), "")


def word_hashes(text: Column) -> Column:
    return F.transform(normal_words(text), lambda word: F.xxhash64(word))


def _first(words: Column) -> Column:
    return F.xxhash64(words)


def _second(words: Column) -> Column:
    return F.xxhash64(F.lit(_SEED), words)


def _probe(words: Column, at: Column, length: Column | int) -> Column:
    """Hash of the first, middle and last word of a window; ``at`` counts from 0."""
    middle, last = F.floor((F.lit(1) * length) / 2).cast("int"), length - 1
    return F.xxhash64(
        F.get(words, at), F.get(words, at + middle), F.get(words, at + last), F.lit(1) * length
    )


def _long_of(probe: Column) -> Column:
    return F.shiftrightunsigned(probe, 6).bitwiseAND(BITMAP_LONGS - 1).cast("int")


def _bit_of(probe: Column) -> Column:
    return probe.bitwiseAND(63).cast("int")


def probe_bitmap(windows: DataFrame) -> DataFrame:
    """One row with an array of ``BITMAP_LONGS`` longs: a bit per probe of a window."""
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit_of(F.col("probe")))
    bits = windows.groupBy(_long_of(F.col("probe")).cast("bigint").alias("id")).agg(
        F.bit_or(one).alias("bits")
    )
    every = windows.sparkSession.range(BITMAP_LONGS).join(bits, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("b"))))
    return every.agg(F.transform(ordered, lambda x: x["b"]).alias("bitmap"))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: ``hash``, ``check``, ``length`` and the items that hold them."""
    hashed = benchmark.select(
        F.col("item_id").cast("string").alias("item"), word_hashes(F.col("text")).alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    windows = hashed.select(
        "item", "w", F.explode(starts).alias("at")
    ).select("item", F.slice("w", F.col("at"), F.lit(n)).alias("w"))
    return windows.groupBy(
        _first(F.col("w")).alias("hash"),
        _second(F.col("w")).alias("check"),
        F.size("w").alias("length"),
        _probe(F.col("w"), F.lit(0), F.size("w")).alias("probe"),
    ).agg(F.collect_set("item").alias("items"))


def window_hits(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per different ``(doc_id, text)``: word count, covered words, items.

    ``doc_id``, ``text_hash`` (two longs), ``n_words``, ``hits`` (array of
    ``start, length``, starts from 0) and ``items``.
    """
    windows = cut_lineage(benchmark_windows(benchmark, n))
    # Lengths present: at most n values.
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())
    small = windows.count() <= BROADCAST_WINDOWS
    lookup = F.broadcast(windows) if small else windows

    # Always BITMAP_LONGS numbers, whatever the size of the benchmark.
    bits = probe_bitmap(windows).first()["bitmap"]
    bitmap = F.lit(np.array(bits, dtype=np.int64))
    words = documents.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(F.lit(_SEED), "text").alias("text_check"),
        word_hashes(F.col("text")).alias("w"),
    )

    def scan(length: int) -> Column:
        def one(at: Column) -> Column:
            part = F.slice("w", at + 1, F.lit(length))
            return F.struct(
                at.alias("start"),
                F.lit(length).alias("size"),
                _first(part).alias("h"),
                _second(part).alias("c"),
            )

        def likely(at: Column) -> Column:
            probe = _probe(F.col("w"), at, length)
            return F.getbit(F.get(bitmap, _long_of(probe)), _bit_of(probe)) == 1

        # A sequence from 0 to less than 0 would run downwards.
        places = F.slice(
            F.sequence(F.lit(0), F.size("w")), F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(0))
        )
        return F.transform(F.filter(places, likely), one)

    # The first entry stands for the document itself and carries its word count.
    own = F.array(
        F.struct(
            F.lit(-1).alias("start"),
            F.size("w").alias("size"),
            F.lit(0).cast("bigint").alias("h"),
            F.lit(0).cast("bigint").alias("c"),
        )
    )
    entries = words.select(
        "doc_id",
        "text_hash",
        "text_check",
        F.explode(F.concat(own, *[scan(length) for length in lengths])).alias("e"),
    ).select("doc_id", "text_hash", "text_check", "e.*")
    same = (
        (F.col("h") == F.col("hash"))
        & (F.col("c") == F.col("check"))
        & (F.col("size") == F.col("length"))
        & (F.col("start") >= 0)
    )
    met = entries.join(lookup, same, "left").where("start < 0 OR hash IS NOT NULL")
    hit = F.when(F.col("start") >= 0, F.struct("start", "length"))
    return met.groupBy("doc_id", "text_hash", "text_check").agg(
        F.max(F.when(F.col("start") < 0, F.col("size"))).cast("bigint").alias("n_words"),
        F.count(F.when(F.col("start") < 0, 1)).alias("copies"),
        F.collect_set(hit).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def covered_words(hits: Column) -> Column:
    """Number of words inside at least one hit: overlaps are counted once."""
    ordered = F.array_sort(hits)
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(state: Column, hit: Column) -> Column:
        end = hit["start"] + hit["length"]
        fresh = F.greatest(end - F.greatest(hit["start"], state["end"]), F.lit(0))
        return F.struct(
            F.greatest(state["end"], end).alias("end"), (state["total"] + fresh).alias("total")
        )

    return F.aggregate(ordered, start, add, lambda state: state["total"])


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document: its words, those inside a test window, the items found."""
    found = window_hits(documents, benchmark, n)
    each = found.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return each.select(
        "doc_id",
        "n_words",
        covered_words(F.col("hits")).cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Documents without any test window, with all their columns."""
    hit = window_hits(documents, benchmark, n).where(F.size("hits") > 0)
    found = hit.select("doc_id", "text_hash", "text_check")
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(F.lit(_SEED), "text").alias("text_check"),
    )
    same = (
        rows["doc_id"].eqNullSafe(found["doc_id"])
        & (rows["text_hash"] == found["text_hash"])
        & (rows["text_check"] == found["text_check"])
    )
    return rows.join(found, same, "left_anti").select("row.*")
