"""Personal data, archives, nearest neighbours and the pipeline."""

from __future__ import annotations

import hashlib
import io
import re

import brute
import cases
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.llm import nearest, personal_data, warc

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile("[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile("\\+[0-9][\x20().0-9-]+[0-9]")),
]


def _plain_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(
                sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))
            )
            right = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if name == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[name]
            if right:
                out.append((k, m.start(), m.end()))
    return out


PRIVATE = [
    (1, "mail a.b@c-d.org, a@b c@d.e_f@g.h.i x@y@z.com +1@2.3 é@ü.de"),
    (2, "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.004 1.2.3"),
    (3, "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 1 2 3 4000 0000 0000 0002"),
    (4, "+1 (555) 010-9999 +49 30 123 +123456789012345678 +1-2.3 4(5)6 7 8 9 é+44 20 7946 0958"),
    (5, None), (6, ""), (None, "x@y.zz"), (7, "1" * 5000 + "@" + "a." * 3000 + " " + "7." * 2000),
    (1, "mail a.b@c-d.org, a@b c@d.e_f@g.h.i x@y@z.com +1@2.3 é@ü.de"),
]


def test_patterns_equal_the_plain_version(spark):
    docs = cases.documents(spark, [*PRIVATE, *cases.texts()])
    got = personal_data.personal_data_report(docs).collect()
    expected = []
    for i, text in cases.pairs(docs):
        spans = _plain_spans(text or "")
        joined = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for k, a, b in spans)
        expected.append((i, *[sum(s[0] == k for s in spans) for k in range(4)], brute.sha(joined), joined))
    assert cases.ordered(tuple(r)[:6] for r in got) == cases.ordered(e[:6] for e in expected)
    assert cases.ordered((r.doc_id, r.spans) for r in got) == cases.ordered((e[0], e[6]) for e in expected)


def _disclosing_rows():
    """'Quillfeather' stands only near one address; other words stand everywhere."""
    rows = [(i, " ".join(cases.prose(i, 100))) for i in range(40)]
    for i in range(40, 48):
        before, after = cases.prose(i, 20), cases.prose(100 + i, 20)
        rows.append((i, " ".join([*before, "Quillfeather", after[0], "at", "q@house.org", *after])))
    return rows


def test_words_that_disclose_an_entity(spark):
    rows = _disclosing_rows()
    docs = cases.documents(spark, rows)
    found = {r.doc_id: r.spans for r in personal_data.personal_data_report(docs).collect()}
    for i, text in rows:
        at = text.find("Quillfeather")
        assert (f"term:{at}:{at + 12}" in (found[i] or "")) == (at >= 0)
    clean = personal_data.sanitise(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert "Quillfeather" not in r.text and "q@house" not in r.text
        assert r.n_chars == len(r.text)
        assert ("[TERM]" in r.text and "[EMAIL]" in r.text) == (r.doc_id >= 40)


@pytest.mark.parametrize("sent", [personal_data.SENT_WORDS, 0])
def test_disclosing_words_go_everywhere(spark, monkeypatch, sent):
    monkeypatch.setattr(personal_data, "SENT_WORDS", sent)
    rows = [*_disclosing_rows(), *((i, " ".join(cases.prose(i, 100))) for i in range(200, 500))]
    # Far from the address in its documents; alone in others.
    rows = [(i, f"{t} {' '.join(cases.prose(1000 + i, 5))} Lampwick" if 40 <= i < 48 else t) for i, t in rows]
    for i in range(48, 51):
        rows.append((i, " ".join([*cases.prose(i, 12), "quillfeather", *cases.prose(900 + i, 12), "Lampwick;", "Quillfeather"])))
    rows.append((None, "Quillfeather"))
    docs = cases.documents(spark, [*rows, rows[-1], (600, None)])
    found = {r.doc_id: r.spans for r in personal_data.personal_data_report(docs).collect()}
    for i, text in rows:
        for m in re.finditer("quillfeather|lampwick", text.lower()):
            assert f"term:{m.start()}:{m.end()}" in found[i]
    clean = {r.doc_id: r.text for r in personal_data.sanitise(docs).collect()}
    assert not any(re.search("quillfeather|lampwick", (t or "").lower()) for t in clean.values())
    assert clean[None] == "[TERM]" and clean[600] is None
    assert all((("[TERM]" in (t or "")) == (i is None or 40 <= i < 51)) for i, t in clean.items())


def test_copies_of_one_text_are_no_evidence(spark):
    text = " ".join([*cases.prose(1, 20), "Rareword", "x@y.org"])
    docs = cases.documents(spark, [(i, text) for i in range(50)] + [(99, None)])
    rows = personal_data.personal_data_report(docs).collect()
    assert not any("term" in r.spans for r in rows)
    assert personal_data.personal_data_report(cases.documents(spark, [])).collect() == []


def test_texts_with_thousands_of_entities(spark):
    """Long texts share many addresses; only words that stand nowhere else disclose them."""
    common = [(i, " ".join(cases.prose(i, 300))) for i in range(200)]
    mails = [f"user{k}@host{k % 7}.org" for k in range(2500)]
    long = []
    for i in range(4):
        words = cases.prose(1000 + i, 400)
        words[50 * i + 17] = "Lampwick"
        long.append((500 + i, " ".join([*words, *mails[: 2500 - 100 * i]])))
    found = {r.doc_id: r for r in personal_data.personal_data_report(cases.documents(spark, common + long)).collect()}
    assert [found[500 + i].n_email for i in range(4)] == [2500, 2400, 2300, 2200]
    for i, text in long:
        at = text.index("Lampwick")
        terms = [x for x in found[i].spans.split(",") if x.startswith("term")]
        assert terms == [f"term:{at}:{at + 8}"]
    assert not any("term" in found[i].spans for i, _ in common)


def test_overlapping_spans_become_one():
    assert personal_data.mask("abcdef", [(0, 1, 3), (4, 2, 5)]) == "a[EMAIL]f"


def _pages(spark):
    big, long = "é" * 60, "page " * 40_000
    rows = [(5, "http://a", big), (3, "http://b\r\nX: y", big), (9, None, big), (4, "u", "small"), (6, "u", "small"),
            (7, "u", None), (8, "u", ""), (None, "u", big), (10, "u", long), (2, "u", long), (2, "u", long), (11, "u", "\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id bigint, url string, html string, digest int, owner string")


def test_archives_come_back_whole(spark, tmp_path):
    pages = _pages(spark)
    rows = warc.archive_report(pages, f"file://{tmp_path}/a").collect()
    first = {}
    for r in pages.collect():
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    expected = []
    for r in pages.collect():
        body = (r.html or "").encode()
        owner = first.get(body)
        again = owner is not None and owner != r.page_id
        expected.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", owner if again else None))
    assert cases.ordered(rows) == cases.ordered(expected)


def test_payloads_and_rolling_archives(spark, tmp_path):
    pages = _pages(spark)
    manifest = warc.write_archives(pages, f"file://{tmp_path}/b", limit=1000)
    assert manifest.count() > 1
    rows = warc.read_archives(manifest, keep=True).collect()
    texts = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert all(bytes(r.payload) == texts[r.page_id] for r in rows if r.record_type == "response")
    none = pages.where("page_id < 0")
    assert warc.archive_report(none, f"file://{tmp_path}/c").collect() == []


def _archive(*payloads):
    return b"".join(
        warc.record_bytes(i, "u", p, hashlib.sha256(p).hexdigest(), None, False) for i, p in enumerate(payloads)
    )


def test_names_of_stores_as_spark_has_them(tmp_path):
    for uri, path in (("s3a://bucket/a/b", "bucket/a/b"), ("s3n://bucket/a", "bucket/a"), (f"file://{tmp_path}/x", f"{tmp_path}/x")):
        assert warc.file_system(uri)[1] == path


def test_damaged_archives_are_refused():
    whole = _archive(b"one" * 50_000, b"", b"two")
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(whole))] == [150_000, 0, 3]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(whole[:-5])))
    wrong = warc.record_bytes(1, "u", b"body", "0" * 64, None, False)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(wrong)))


def _vectors(spark, rows):
    full = [(i, v, 0, "x", 1) for i, v in rows]
    return spark.createDataFrame(full, "vec_id bigint, embedding array<double>, label int, id string, shard int")


def _exact(rows, k=20):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    out = {}
    for q, x in good:
        if q is not None and q % 20 == 0:
            near = [(-float((v * x).sum()), i) for i, v in good if i != q and len(v) == len(x)]
            out[q] = [(i, -s) for s, i in sorted(near, key=lambda p: (p[0], p[1] is None, p[1] or 0))[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [100, 10_000])
def test_neighbours_of_a_small_table_with_copies(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * (1 + i % 3)).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 400)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [None] + [1.0] * 7), (420, [float("nan")] * 8),
             (440, [float("inf")] * 8), (460, [1.0, 2.0]), (461, [2.0, 1.0]), (None, [1.0] * 8)]
    data = _vectors(spark, rows)
    found = nearest.search(nearest.build_index(data, shard_rows), data.where("vec_id % 20 = 0")).collect()
    exact = _exact(rows)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert got.keys() == exact.keys()
    met = [len({i for i, _ in got[q]} & {i for i, _ in exact[q]}) / len(exact[q]) for q in exact]
    assert np.mean(met) > 0.97
    assert all(len(got[q]) == len(exact[q]) for q in exact)
    scores = {(q, i): s for q in exact for i, s in exact[q]}
    assert all(scores[q, i] == pytest.approx(s, rel=1e-12) for q in got for i, s in got[q] if (q, i) in scores)


@pytest.mark.parametrize("size", [1e-300, 1e-30, 1e25, 1e150])
def test_numbers_of_any_size(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * size).tolist()) for i in range(200)]
    found = nearest.neighbours_of_every_twentieth(_vectors(spark, rows)).collect()
    exact, got = _exact(rows), {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert got.keys() == exact.keys() and all(len(got[q]) == 20 for q in got)
    if size > 1e-200:  # products of the smallest are all zero
        assert np.mean([len(got[q].keys() & {i for i, _ in exact[q]}) / 20 for q in exact]) > 0.97


def test_lengths_of_many_sizes_in_one_table(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=5) * 10.0 ** (int(i % 9) * 6 - 24)).tolist()) for i in range(600)]
    got = {}
    for r in nearest.neighbours_of_every_twentieth(_vectors(spark, rows)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    exact = _exact(rows)
    assert np.mean([len(got[q] & {i for i, _ in exact[q]}) / 20 for q in exact]) > 0.95


def test_every_node_is_reached_and_hubs_lose_no_link():
    rng = np.random.default_rng(5)
    # A dense cluster, far lone vectors and a few very long ones.
    cluster = rng.normal(size=(1500, 6)) * 0.01 + 1
    lone = rng.normal(size=(300, 6)) * 5
    vectors = np.unique(np.concatenate([cluster, lone, rng.normal(size=(5, 6)) * 400]), axis=0)
    edges, entry = nearest.build_graph(vectors)
    seen = np.zeros(len(vectors), dtype=bool)
    nearest._reached(edges, np.array([entry]), seen)
    assert seen.all()
    apart = np.full((40, nearest.DEGREE), -1)
    linked = nearest._all_reached(nearest.lifted(rng.normal(size=(40, 3))), apart, 0)
    seen = np.zeros(40, dtype=bool)
    nearest._reached(linked, np.array([0]), seen)
    assert seen.all()


def test_rows_that_repeat_a_vector_are_each_found(spark):
    rows = [(20, [1.0, 0.0])] + [(7, [2.0, 0.0])] * 3 + [(9, [1.5, 0.0])] * 40 + [(i, [0.1, float(i)]) for i in range(30, 40)]
    found = nearest.neighbours_of_every_twentieth(_vectors(spark, rows)).where("query_id = 20").collect()
    got = [r.vec_id for r in sorted(found, key=lambda r: r["rank"])]
    assert got == [7] * 3 + [9] * 17


def test_recall_on_the_drivers_vectors(spark):
    data = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in data.collect()]
    exact = _exact(rows)
    got = {}
    for r in nearest.neighbours_of_every_twentieth(data).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in exact[q]}) / 20 for q in exact]) > 0.9


def test_no_vectors(spark):
    assert nearest.neighbours_of_every_twentieth(_vectors(spark, [])).collect() == []
    assert nearest.neighbours_of_every_twentieth(_vectors(spark, [(20, None)])).collect() == []
    assert nearest.neighbours_of_every_twentieth(_vectors(spark, [(20, [1.0])])).collect() == []


def test_pipeline_stage_by_stage(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "packing",
    ]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, sf)
        rows = after.collect()
        ids = sorted(r.doc_id for r in rows)
        if name != "packing":
            assert after.columns == columns
        if name == "near_duplicates":
            plain = brute.near_duplicates([(r.doc_id, r.text) for r in before], width=5)
            assert ids == sorted(i for i, (_, c) in plain.items() if i == c)
        elif name == "decontamination":
            plain = brute.contamination([(r.doc_id, r.text) for r in before], items)
            assert ids == sorted(r[0] for r in plain if not r[5])
        elif name == "personal_data":
            assert ids == sorted(r.doc_id for r in before)
            assert not any(_plain_spans(r.text) for r in rows)
        elif name == "packing":
            assert set(ids) == {r.doc_id for r in before}
        else:
            assert 0 < len(ids) < len(before)
        docs = spark.createDataFrame(rows, after.schema)


def test_pipeline_on_awkward_documents(spark, tmp_path):
    cases.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").withColumn("row", F.lit(1)).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) > 5 and all(1 <= r.length <= 2048 for r in rows)
    # Nothing is lost but copies, hits and toxic texts: the lone ones are there, also without an id.
    kept = {r.doc_id for r in rows}
    assert {60, 61, None} <= kept <= {i for i, _ in cases.texts()} | {None}
    pieces = [(r.doc_id, r.piece, r.start) for r in rows if r.doc_id is not None]
    assert len(pieces) == len(set(pieces))


def test_pipeline_on_an_empty_table(spark, tmp_path):
    cases.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
