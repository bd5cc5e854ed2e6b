"""Fill-in-the-middle, vector codes and quality rules against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import brute
import cases
import numpy as np
import pyarrow as pa
import pytest

from verdure.llm import code_compression, fill_in_middle, quality_rules
from verdure.llm.words import text_chunks

MARKED = [
    (70, "a <P> in the text"), (71, "b <S>"), (72, "<M>"), (73, "<< S> <P"), (74, "é" * 40 + "abc" * 300 + "ü"),
    (75, "x"), (76, "ß"), (77, "a1b2" * 2000), (78, "Z" * 5000 + "." + "z" * 5000), (79, "<S" * 30 + "P>" * 30),
    (80, "😀 words 😀" * 100),
]


def _plain_middle(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    text = text or ""
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), out


def test_middles_equal_the_plain_version(spark):
    given = cases.texts()
    docs = cases.documents(spark, [*given, *MARKED, given[7], (None, "no id"), (None, None)]).repartition(3)
    expected = [_plain_middle(i, t) for i, t in cases.pairs(docs)]
    got = fill_in_middle.fill_in_middle(docs).collect()
    assert cases.ordered(got) == cases.ordered(expected)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}

    report = fill_in_middle.fill_in_middle_report(docs).collect()
    texts = {(i, brute.sha(t or "")) for i, t in cases.pairs(docs)}
    assert {(r.doc_id, r.restored_sha256) for r in report} == texts
    assert {(r.doc_id, r.output_sha256) for r in report} == {(e[0], brute.sha(e[5])) for e in expected}


def test_middles_of_an_empty_table(spark):
    assert fill_in_middle.fill_in_middle_report(cases.documents(spark, [])).collect() == []


def test_shared_chunks_are_counted_once_and_memory_is_bounded():
    shared = " ".join(cases.prose(5, 4000))
    texts = [" ".join(cases.prose(100 + i, 30)) + " " + shared for i in range(8)]
    (_, _, data, offsets), = text_chunks(pa.array(texts))
    sums = fill_in_middle.ChunkSums()
    units = fill_in_middle.TextUnits(data, offsets, sums)
    chunks = len(units.edges) - 1
    assert sums.n_counted < 0.25 * chunks
    small = fill_in_middle.ChunkSums(limit=2000)
    for part in (texts[:4], texts[4:]):
        (_, _, data, offsets), = text_chunks(pa.array(part))
        again = fill_in_middle.TextUnits(data, offsets, small)
        for i, text in enumerate(part):
            found = re.findall("[A-Za-z]+|[^A-Za-z]", text)
            assert again.count(i) == len(found)
            for n in (0, 1, len(found) // 3, len(found) - 1, len(found)):
                assert again.end_of(i, n)[1] == len("".join(found[:n]))


def _plain_codes(rows):
    """(vec_id, code, error) by full comparison of Python integers, and the codebooks."""
    usable = [
        (i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(usable[0][2]) // 16
    parts = [[v[p * width : (p + 1) * width] for p in range(16)] for _, _, v in usable]
    books = [[list(x[p]) for x in parts[:64]] for p in range(16)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(3):
        found = [[min((away(x[p], e), k) for k, e in enumerate(books[p])) for p in range(16)] for x in parts]
        if turn < 2:
            for p in range(16):
                for k in range(len(books[p])):
                    mine = [x[p] for x, f in zip(parts, found, strict=True) if f[p][1] == k]
                    if mine:
                        books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    error = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, label, _), e in zip(usable, error, strict=True):
        by_label[label] += e
    flat = ",".join(str(x) for part in books for e in part for x in e)
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], brute.sha(flat))
        for (i, label, _), f, e in zip(usable, found, error, strict=True)
    ]


def _vectors(n, width, seed, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    rows = []
    for i in range(n):
        c = centres[i % 9]
        rows.append((i * 3, i % 4 if i % 5 else None, [float(np.float32(x + rng.gauss(0, spread))) for x in c]))
    return rows


AWKWARD = [
    (1, 1, None), (4, 1, [None] * 32), (7, 2, [float("nan")] * 32), (10, 2, [math.inf] + [0.0] * 31),
    (None, 3, [0.25] * 32), (13, 3, [0.0] * 32), (16, None, [0.0] * 32), (19, 1, [-0.001] * 32),
]


@pytest.mark.parametrize("rows", [
    _vectors(400, 32, 1) + AWKWARD,
    _vectors(300, 32, 2, 0.01)[:200] * 2 + AWKWARD,  # repeated rows and ties
    _vectors(20, 16, 3),  # fewer than entries
    [(i, i % 3, [1e9 * math.sin(i * k + k) for k in range(32)]) for i in range(90)] ,
    [(i, 0, [float((i * k) % 3) / 256 for k in range(32)]) for i in range(200)],  # many equal distances
])
def test_codes_equal_full_comparison(spark, rows):
    schema = "vec_id bigint, label int, embedding array<double>, codes int, error int, part int, vector int"
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema).repartition(3)
    expected = _plain_codes(rows)
    if max(e[2] for e in expected) > (1 << 63) - 1:
        with pytest.raises(Exception, match="does not fit a long"):
            code_compression.code_report(table).collect()
        return
    assert cases.ordered(code_compression.code_report(table).collect()) == cases.ordered(expected)


def test_large_numbers_stay_exact(spark):
    rows = [(i, i % 2, [2.0**40 * (i % 5) + k + i / 7 for k in range(16)]) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    assert cases.ordered(code_compression.code_report(table).collect()) == cases.ordered(_plain_codes(rows))


def test_codes_of_tables_without_usable_rows(spark):
    schema = "vec_id bigint, label int, embedding array<float>"
    for rows in ([], [(1, 1, None), (2, 1, [])], [(1, 1, [0.5] * 15)]):
        assert code_compression.code_report(spark.createDataFrame(rows, schema)).collect() == []


def test_balls_rule_out_most_comparisons():
    rng = np.random.default_rng(4)
    part = rng.integers(-400, 400, (5000, 4)) // 40 * 40 + rng.integers(-9, 10, (5000, 4))
    book = part[:64].copy()
    codes, best = code_compression.nearest_of_all(part, book)
    moved = np.array([part[codes == e].sum(axis=0) // (codes == e).sum() for e in range(64)])
    books = code_compression.Codebooks([moved.tolist()], [[0] * 64])
    far = code_compression._squares(part, moved[codes])
    books.radii = [[int(far[codes == e].max()) for e in range(64)]]
    new, distance, made = code_compression.nearest_in_balls(part, codes, moved, books.neighbours(0))
    full, least = code_compression.nearest_of_all(part, moved)
    assert (new == full).all() and (distance == least).all()
    assert made < 0.5 * len(part) * len(book)


def _plain_rules(text):
    text = text or ""
    words = brute.BLANK.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if brute.BLANK.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
        n < 20 or 100 * len(hit) > 30 * n,
    )


def _plain_ratio(docs, good):
    grams = {}
    for k, (_, text) in enumerate(docs):
        raw = (text or "").encode()
        values = []
        for i in range(len(raw) - 2):
            value = 0
            for b in raw[i : i + 3]:
                value = (value * 257 + b) % 2**32
            values.append((value * 0x9E3779B1) % 2**32 >> 16)
        grams[k] = values
    raw, target = Counter(), Counter()
    for k, (i, _) in enumerate(docs):
        raw.update(grams[k])
        if i in good:
            target.update(grams[k])
    size = 1 << 16
    n_raw, n_target = sum(raw.values()) + size, sum(target.values()) + size
    out = []
    for k in range(len(docs)):
        total = 0
        for g in grams[k]:
            total += int(np.rint(np.log((target[g] + 1.0) / n_target * (n_raw / (raw[g] + 1.0))) * (1 << 20)))
        out.append(total // max(len(grams[k]), 1))
    return out


def _rule_rows():
    """Prose, and junk with marks behind every word."""
    rows = list(cases.texts())
    for i in range(100, 160):
        words = cases.prose(i, 60)
        rows.append((i, " ".join(words) if i % 2 else " ".join(w + "$$$" for w in words)))
    rows.append((200, "one line of some words\n\n  \none line of some words\nother\none line of some words "))
    rows.append((201, "a b c d e f g h x a b c d e f g h y " + " ".join(cases.prose(7, 30))))
    rows.append((202, "a b c d e f g a b c d e f g a b c d " + " ".join(cases.prose(6, 30))))
    rows.append((203, "\n".join(["x|y"] * 4) + "   wide blanks are no blanks \x0b\x0c # < >"))
    return rows


def test_rules_equal_the_plain_version(spark):
    docs = cases.documents(spark, [*_rule_rows(), (10, "a repeated id with another text"), (None, "x y"), (None, None)])
    label_rows = [(i, i % 2, 0) for i in range(100, 160)] + [(None, 1, 0), (10, None, 0), (101, 0, 0), (9999, 1, 1)]
    labels = spark.createDataFrame(label_rows, "doc_id bigint, quality int, toxic int")
    rows = cases.pairs(docs)
    got = quality_rules.quality_rules(docs.repartition(3), labels).collect()
    import zlib

    out_of_fold = {i for i in range(100, 160) if zlib.crc32(str(i).encode()) % 4 != 2}
    ratio = _plain_ratio(rows, {i for i in out_of_fold if i % 2} | {9999})
    expected = [(i, *_plain_rules(t)[:5], r, _plain_rules(t)[5]) for (i, t), r in zip(rows, ratio, strict=True)]
    assert cases.ordered(tuple(r)[:8] for r in got) == cases.ordered(expected)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(101, 160, 2))
    assert not any(kept[i] for i in range(100, 160, 2))
    assert all(r.kept <= (not r.base_failed) for r in got)


def test_rules_without_labels_or_documents(spark):
    schema = "doc_id bigint, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    docs = cases.documents(spark)
    got = quality_rules.rules_report(docs, none).collect()
    assert all(r.kept == (not r.base_failed) and r.score == 0 for r in got)
    only_good = spark.createDataFrame([(10, 1, 0), (11, 1, 0)], schema)
    kept = {r.doc_id: r.kept for r in quality_rules.rules_report(docs, only_good).collect()}
    assert kept[10] and kept[11]
    assert quality_rules.rules_report(cases.documents(spark, []), none).collect() == []


def _plain_threshold(rows, known):
    """The rule of ``threshold`` over ``(doc_id, ratio)`` and ``{doc_id: label}``, bin by bin."""
    half = quality_rules.LEVELS // 2
    seen = [(max(min(r // quality_rules.LEVEL, half - 1), -half), known[i]) for i, r in rows if i in known]
    levels = sorted({x for x, _ in seen})
    right = [sum((x >= at) == (label == 1) for x, label in seen) for at in levels]
    best = right.index(max(right))
    below = levels[best - 1] if best else levels[0] - 1
    at = (below + 1 + levels[best]) // 2
    return at * quality_rules.LEVEL if at > -half else None


def test_labels_of_small_files_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes the size of a table from its files, and these hold many rows in few bytes."""
    import zlib

    n = 3000
    label_rows = [(i, int(i % 3 > 0), 0) for i in range(n)] + [(5, 0, 0), (6, 1, 0), (7, None, 0), (None, 1, 0)]
    spark.createDataFrame(label_rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels")
    rng = random.Random(5)
    rows = [(i, rng.randint(-9, 5) * quality_rules.LEVEL + (i % 3 > 0) * 7 * quality_rules.LEVEL + i) for i in range(n)]
    # A hot id in one bin and in many, an id without a label, NULL ids, ratios beyond both ends.
    rows += [(1, 3)] * 500 + [(4, k * quality_rules.LEVEL) for k in range(-40, 40)] + [(n + 1, 0), (None, 1), (None, 1)]
    rows += [(8, 1 << 40), (9, -(1 << 40))]
    spark.createDataFrame(rows, "doc_id bigint, ratio bigint").write.parquet(f"{tmp_path}/measured")
    measured, labels = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("measured", "labels"))

    plans, kind = [], type(measured)
    collect = kind.collect

    def seen(df):
        found = collect(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(kind, "collect", seen)
    least = quality_rules.threshold(measured, labels)
    assert plans and not any("Broadcast" in p for p in plans)
    known = {}
    for i, label, _ in label_rows:
        if i is not None and label is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            known[i] = max(label, known.get(i, 0))
    assert least == _plain_threshold(rows, known)


def test_held_out_share_on_the_given_data(spark):
    """Good documents of the held-out fold stay, bad ones mostly go."""
    from pyspark.sql import functions as F

    from verdure.llm.labelled import held_out

    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_rules.rules_report(documents, labels).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    share = {r.quality: r.kept for r in scored.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.9 and share[0] < 0.2
