"""Substring dedup, near duplicates and decontamination against plain versions."""

from __future__ import annotations

import random

import brute
import cases
import pytest
from pyspark.sql import functions as F

from verdure.llm import decontamination, graph, near_duplicates, substrings

SMALL = "/root/testdata/sf0.001"


def test_substrings_equal_the_plain_version(spark):
    docs = cases.documents(spark)
    got = substrings.remove_repeats(docs).collect()
    assert cases.ordered(got) == cases.ordered(brute.substring_dedup(cases.pairs(docs)))
    assert sum(r.n_removed for r in got) > 3000


@pytest.mark.parametrize(("window", "kmer"), [(2, 1), (5, 3), (12, 12)])
def test_substrings_of_other_lengths(spark, window, kmer):
    rows = [(i, t) for i, t in cases.texts() if len(t or "") < 5000]
    rows += [(100 + i, " ".join("ab"[(i >> k) & 1] for k in range(6)) * 3) for i in range(30)]
    docs = cases.documents(spark, rows)
    got = substrings.remove_repeats(docs, window, kmer).collect()
    assert cases.ordered(got) == cases.ordered(brute.substring_dedup(rows, window))


def test_kept_text_is_the_text_of_the_hash(spark):
    docs = cases.documents(spark)
    rows = substrings.remove_repeats(docs, with_text=True).collect()
    assert all(brute.sha(r.kept_text) == r.kept_sha256 for r in rows)


def test_near_duplicates_equal_the_plain_version(spark):
    rows = cases.texts()
    found = near_duplicates.duplicate_report(cases.documents(spark, rows)).collect()
    expected = brute.near_duplicates(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "other words are here now"), (7, "other words are here now"),
            (None, "a b c d e f"), (None, None), (9, "nothing like the rest at all")]
    found = near_duplicates.duplicate_report(cases.documents(spark, rows)).collect()
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=str)
    assert got == sorted([(5, 5, True)] * 3 + [(7, 5, False), (None, 5, False), (None, None, True), (9, 9, True)], key=str)
    kept = near_duplicates.drop_duplicates(cases.documents(spark, rows), width=4)
    # 5 stands with two texts: one of them goes for the copy under 7, the other stays.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(5, "a b c d e f"), (7, "other words are here now"), (9, "nothing like the rest at all"), (None, None)], key=str
    )


def test_no_text_is_lost_where_an_id_repeats(spark):
    a, b, c = (" ".join(cases.prose(k, 60)) for k in (41, 42, 43))
    near = " ".join([*b.split()[:-1], "another"])
    for rows in ([(5, a), (5, b), (7, b)], [(5, a), (5, b), (7, near)], [(7, a), (5, a), (5, b), (7, b)], [(5, a), (5, a)]):
        docs = cases.documents(spark, [*rows, (9, c)])
        kept = near_duplicates.drop_duplicates(docs)
        assert kept.columns == docs.columns
        texts = [r.text for r in kept.collect()]
        assert len(texts) == len(set(texts)) == len({t if t != near else b for _, t in rows}) + 1
        assert a in texts and c in texts


def test_a_star_of_copies_that_link_only_through_its_centre(spark):
    # Each leaf keeps enough of the centre; two leaves do not have enough in common.
    base = cases.prose(21, 400)
    rows = [(500, " ".join(base))]
    for i in range(120):
        leaf = list(base)
        for k in range(10):
            leaf[(i * 37 + k * 39) % 400] = f"leaf{i}x{k}"
        rows.append((i, " ".join(leaf)))
    found = near_duplicates.duplicate_report(cases.documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {
        i: c for i, (_, c) in brute.near_duplicates(rows).items()
    }


def test_a_crowded_family_with_pairs_that_no_pivot_joins(spark):
    # Two members have about 0.74 in common, each planted pair 0.81.
    rng = random.Random(77)
    base = cases.prose(31, 240)
    slots = [4 * k + 1 for k in range(59)]

    def changed(words, at, name):
        new = list(words)
        for k in at:
            new[k] = f"{name}x{k}"
        return new

    family = [changed(base, rng.sample(slots, 5), f"m{i}") for i in range(1000)]
    rows = [(i, " ".join(w)) for i, w in enumerate(family)]
    for i in range(30):
        alone = [k for k in slots if family[i * 7][k] == base[k]]
        rows.append((2000 + i, " ".join(changed(family[i * 7], rng.sample(alone, 6), f"p{i}"))))
    expected = brute.near_duplicates(rows)
    assert all(expected[2000 + i][1] == expected[i * 7][1] for i in range(30))
    assert len({c for _, c in expected.values()}) > 700
    found = near_duplicates.duplicate_report(cases.documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c) in expected.items()}


def test_small_corpus_of_the_driver(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = cases.pairs(docs)
    found = near_duplicates.duplicate_report(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(rows)
    assert cases.ordered(substrings.remove_repeats(docs).collect()) == cases.ordered(
        brute.substring_dedup(rows)
    )
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hits = decontamination.contamination(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert cases.ordered(hits.collect()) == cases.ordered(brute.contamination(rows, items))


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.union(spark.createDataFrame([(100, 200), (200, 100), (7, 7)], "a bigint, b bigint"))
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog again, and again!"),
    (2, "Short item"),
    (3, None),
    (4, " .,; "),
    (5, "short ITEM"),
    (6, "été Ünder x1"),
]


def test_contamination_equals_the_plain_version(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("hash", F.lit(1))
    rows = [
        (1, "he said: the QUICK-brown fox jumps over the lazy dog again and again so"),
        (2, "the quick brown fox jumps over the lazy cat"),
        (3, "a short item, a short  item short"),
        (4, None), (5, ""), (None, "a short item"), (6, "été Ünder X1 été ünder x1"),
        (7, "the short item. " * 500),
        (7, "the short item. " * 500),
    ]
    docs = cases.documents(spark, rows)
    got = decontamination.contamination(docs, items).collect()
    assert cases.ordered(got) == cases.ordered(brute.contamination(rows, ITEMS))
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect())) == [2, 4, 5]


def test_an_empty_benchmark_and_a_large_one(spark, monkeypatch):
    rows = [(1, "some words"), (2, None)]
    docs = cases.documents(spark, rows)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_hit for r in decontamination.contamination(docs, none).collect()} == {0}
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [(1, "a short item"), (2, "not")]
    got = decontamination.contamination(cases.documents(spark, rows), items).collect()
    assert cases.ordered(got) == cases.ordered(brute.contamination(rows, ITEMS))


def test_empty_tables(spark):
    none = cases.documents(spark, [])
    assert substrings.remove_repeats(none).collect() == []
    assert near_duplicates.duplicate_report(none).collect() == []
    assert near_duplicates.drop_duplicates(none).collect() == []
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontamination.contamination(none, items).collect() == []


def _colliding_words() -> tuple[str, str]:
    """Two words of 2,048 letters with one hash modulo 2**64, for any base and values of bytes."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_in_one_hash_are_told_apart(spark):
    import numpy as np

    from verdure.llm.words import split_words

    one, two = _colliding_words()
    data = np.frombuffer(f"{one} {two}".encode(), dtype=np.uint8)
    plain = split_words(data, np.array([0, len(data)])).hashes
    checked = split_words(data, np.array([0, len(data)]), checked=True)
    assert plain[0] == plain[1]
    assert checked.hashes[0] != checked.hashes[1] and checked.checks[0] != checked.checks[1]
    rows = [(i, " ".join([*cases.prose(3, 30), word, *cases.prose(4, 30)])) for i, word in ((1, one), (2, two), (3, one))]
    docs = cases.documents(spark, rows)
    assert cases.ordered(substrings.remove_repeats(docs).collect()) == cases.ordered(brute.substring_dedup(rows))
    found = near_duplicates.duplicate_report(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(rows)
