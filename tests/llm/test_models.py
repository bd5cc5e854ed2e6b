"""Toxicity and quality: held-out accuracy, awkward texts, missing labels."""

from __future__ import annotations

import cases
import numpy as np
import pytest

from verdure.llm import quality, toxicity
from verdure.llm.labelled import labelled_sample

DATA = "/root/testdata/sf0.1"


def _held_out(rows, labels, column):
    known = {r.doc_id: r[column] for r in labels.collect()}
    return [(r.score, r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = _held_out(toxicity.toxicity_report(docs, labels).collect(), labels, "toxic")
    caught = [p for _, p, y in rows if y]
    wrong = [p for _, p, y in rows if not y]
    assert len(rows) > 900
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.05


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = _held_out(quality.quality_report(docs, labels).collect(), labels, "quality")
    right = np.mean([p == y for _, p, y in rows])
    low = np.mean([p == 0 for _, p, y in rows if y == 0])
    assert right > 0.93 and low > 0.85


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, toxic int, quality int, text string, score int")


@pytest.mark.parametrize("report", [toxicity.toxicity_report, quality.quality_report])
def test_awkward_documents_are_scored(spark, report):
    docs = cases.documents(spark)
    flags = [(i, i % 2, i % 2, None, 1) for i, _ in cases.texts()] + [(1, None, None, None, None), (None, 1, 1, "", 0)]
    rows = report(docs, _labels(spark, flags)).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    twice = [r.score for r in rows if r.doc_id == 10]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert len({round(r.score, 12) for r in rows if r.doc_id in (1, 2)}) == 1


@pytest.mark.parametrize("report", [toxicity.toxicity_report, quality.quality_report])
@pytest.mark.parametrize(("flags", "score"), [([], 0.0), ([(4, 1, 1, None, 1), (5, 1, 1, None, 1)], 1.0)])
def test_without_both_labels_the_score_is_their_share(spark, report, flags, score):
    rows = report(cases.documents(spark), _labels(spark, flags)).collect()
    assert {r.score for r in rows} == {score}
    assert report(cases.documents(spark, []), _labels(spark, flags)).collect() == []


def test_the_held_out_fold_is_not_learned_from(spark):
    import zlib

    docs = cases.documents(spark, [(i, f"text {i}") for i in range(200)])
    sample = labelled_sample(docs, _labels(spark, [(i, i % 2, 0, None, 0) for i in range(200)]), "toxic", 30)
    numbers = [int(t.split()[1]) for t in sample.texts]
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in numbers)
    assert sample.labels == [i % 2 for i in numbers] and sample.labels.count(1) == 30
    assert sum(sample.sizes) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))


def _toxic_corpus():
    """Toxic words begin with 'zorg' or are 'blah'; they stand in every other document."""
    out = []
    for i in range(240):
        words = cases.prose(1000 + i, 60, 2000)
        if i % 2:
            words[5], words[6], words[40] = "Blah", f"zorg{words[1]}", "blah"
        out.append((i, " ".join(words)))
    return out


def test_spans_cover_the_toxic_words(spark):
    rows = _toxic_corpus()
    docs = cases.documents(spark, rows)
    labels = _labels(spark, [(i, i % 2, 0, None, 0) for i, _ in rows])
    found = toxicity.toxicity_report(docs, labels).collect()
    text = dict(rows)
    for r in found:
        marked = [text[r.doc_id][s.start : s.end].lower() for s in r.spans]
        if r.doc_id % 2:
            assert any("blah" in m for m in marked)
            assert r.predicted == 1
        else:
            assert r.predicted == 0 and not marked
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == list(range(0, 240, 2))


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(4)
    scores, transitions = rng.normal(size=(1, 6)), rng.normal(size=4)
    _, ahead, back = toxicity.forward_backward(scores, np.ones((1, 6), dtype=bool), transitions)
    weight = np.zeros(64)
    for tags in range(64):
        bits = [(tags >> k) & 1 for k in range(6)]
        total = sum(scores[0, k] for k in range(6) if bits[k])
        total += sum(transitions[2 * a + b] for a, b in zip(bits, bits[1:], strict=False))
        weight[tags] = np.exp(total)
    for k in range(6):
        exact = sum(weight[t] for t in range(64) if (t >> k) & 1) / weight.sum()
        odds = ahead[0, k] * back[0, k]
        assert odds / (1 + odds) == pytest.approx(exact)
