"""Personal data by pattern, and terms that disclose it by co-occurrence.

Patterns find e-mail, IP, card and phone spans; each distinct value found is a
protected entity. Words that occur with an entity may disclose it even when its
own span is masked. Over the whole corpus the operator counts how often each
word occurs at all, and how often with each entity, at two ranges:

* within ``REACH`` words of it, and in how many different contexts, so that
  copies of a text are no evidence;
* in the same document, and in how many different texts and contexts.

A word discloses an entity if, at either range, at least ``SHARE`` of all its
occurrences are with the entity, in at least ``CONTEXTS`` contexts, and if
seeing the word tells at least ``BITS`` bits about the entity (pointwise mutual
information). All occurrences of such words, in all documents, are spans of kind
``term``. Sanitising replaces every span by the name of its kind, the most
general value.

Defined results: NULL is an empty text; rows with the same id and text are
found alike; offsets are code points, end exclusive; an empty table discloses
nothing. Other columns are kept as they are, ``n_chars`` follows the new text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.llm.words import signed, span_hashes, split_words, text_chunks
from verdure.operators.joins import join_by_key
from verdure.sources.lineage import cut_lineage

KINDS = ("email", "ip", "card", "phone", "term")
REACH = 8
CONTEXTS = 3
SHARE = 0.5
BITS = 4.0
#: Distinct words that a task counts before it hands its counts on.
HELD_WORDS = 1 << 19
#: Disclosing words that are sent to the tasks; more are joined to the words of all texts.
SENT_WORDS = 1 << 18

# A match starts where a run of its first class starts, or where the last match ended;
# from inside a run the same characters fail again. This keeps long runs linear.
_EMAIL = regex.compile(
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
)
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile("[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile("\\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_WORD = np.ones(256, dtype=bool)
_NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _is_ip(value: str) -> bool:
    # Leading zeros may be many; the number counts.
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the patterns, by kind and start."""
    out = []
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text) is None:
        return out
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _entity(kind: int, value: str) -> int:
    plain = value.lower() if kind < 2 else "".join(_DIGIT.findall(value))
    raw = f"{kind}:{plain}".encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    no_blank = np.zeros(256, dtype=bool)
    return int(signed(split_words(data, np.array([0, len(raw)]), blank=no_blank).hashes)[0])


def _split(text: str, spans: list[tuple[int, int, int]]):
    """Words of ``text``, their starts and ends in code points, and which of them spans cover."""
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    words = split_words(data, np.array([0, len(raw)]), lower=True, blank=_NOT_WORD)
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    starts, ends = points[words.starts], points[words.ends]
    covered = np.zeros(len(starts), dtype=bool)
    for _, begin, end in spans:
        covered[np.searchsorted(ends, begin, "right") : np.searchsorted(starts, end)] = True
    return words, starts, ends, covered


def _words_with(text: str, spans: list[tuple[int, int, int]], reach: int):
    """Word, entity, context and start of words near the spans, word and context of all words, and the entities."""
    words, starts, ends, covered = _split(text, spans)
    sums, places = words.prefix(), np.arange(len(starts))
    context = signed(span_hashes(sums, np.maximum(places - 2, 0), np.minimum(places + 3, len(places))))
    hashes = signed(words.hashes)
    near, entities = set(), set()
    for kind, begin, end in spans:
        entity = _entity(kind, text[begin:end])
        entities.add(entity)
        lo = max(int(np.searchsorted(ends, begin, "right")) - reach, 0)
        hi = int(np.searchsorted(starts, end)) + reach
        near |= {
            (int(hashes[i]), entity, int(context[i]), int(starts[i]))
            for i in range(lo, min(hi, len(starts)))
            if not covered[i]
        }
    every = [{"word": w, "context": c} for w, c in zip(hashes[~covered].tolist(), context[~covered].tolist(), strict=True)]
    names = ("word", "entity", "context", "start")
    return [dict(zip(names, x, strict=True)) for x in sorted(near)], every, sorted(entities)


_SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.ByteType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)
_NEAR = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.LongType()) for n in ("word", "entity", "context")] + [T.StructField("start", T.IntegerType())]
    )
)
_EVERY = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("word", "context")]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32())]))
_ARROW_NEAR = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("word", "entity", "context")] + [("start", pa.int32())])
)
_ARROW_EVERY = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "context")]))


def _parts(batches: Iterator[pa.RecordBatch]):
    """Parts of batches with their texts and the spans of the patterns."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield part, texts, [base_spans(t) for t in texts]


def _named(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def _find(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, spans in _parts(batches):
            met = [_words_with(t, s, reach) if s else ([], [], []) for t, s in zip(texts, spans, strict=True)]
            near, every, entities = zip(*met, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array(near, _ARROW_NEAR), pa.array(every, _ARROW_EVERY), pa.array(entities, pa.list_(pa.int64()))],
                ["text_key", "near", "every", "entities"],
            )

    return run


def _term_spans(sent: np.ndarray):
    """Spans of the patterns, and of all words whose hashes are in ``sent`` (sorted)."""

    def terms(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
        if not len(sent):
            return []
        words, starts, ends, covered = _split(text, spans)
        hashes = signed(words.hashes)
        at = np.minimum(np.searchsorted(sent, hashes), len(sent) - 1)
        told = (sent[at] == hashes) & ~covered
        kind = len(KINDS) - 1
        return _named([(kind, a, b) for a, b in zip(starts[told].tolist(), ends[told].tolist(), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, spans in _parts(batches):
            added = [terms(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([_named(s) for s in spans], _ARROW_SPANS), pa.array(added, _ARROW_SPANS)],
                ["doc_id", "text_key", "spans", "terms"],
            )

    return run


def _word_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each word outside the spans of the patterns."""
    for part, texts, spans in _parts(batches):
        for i, (text, own) in enumerate(zip(texts, spans, strict=True)):
            words, starts, ends, covered = _split(text, own)
            owner = pa.array(np.full(int((~covered).sum()), i))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(owner), part.column(1).take(owner), pa.array(signed(words.hashes)[~covered]),
                    pa.array(starts[~covered], pa.int32()), pa.array(ends[~covered], pa.int32()),
                ],
                ["doc_id", "text_key", "word", "start", "end"],
            )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word in the texts of a task, handed on when many are held."""

    def merged(parts):
        words = np.concatenate([w for w, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        unique, inverse = np.unique(words, return_inverse=True)
        return unique, np.bincount(inverse, weights=counts, minlength=len(unique)).astype(np.int64)

    def batch_of(words, counts):
        return pa.RecordBatch.from_arrays([pa.array(signed(words)), pa.array(counts)], ["word", "n"])

    parts, held = [], 0
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            found = split_words(data, offsets, lower=True, blank=_NOT_WORD)
            parts.append(np.unique(found.hashes, return_counts=True))
            held += len(parts[-1][0])
            if held > HELD_WORDS:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > HELD_WORDS // 2:
                    yield batch_of(*parts[0])
                    parts, held = [], 0
    if parts:
        yield batch_of(*merged(parts))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _among(rows: DataFrame, column: str, words: DataFrame, salt_from: list[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``words`` (a written table of different words)."""
    words = words.select(F.col("word").alias("_among"))
    if words.count() <= SENT_WORDS:
        return rows.join(F.broadcast(words), F.col(column) == F.col("_among"), "left_semi")
    return join_by_key(rows, column, words, "_among", "left_semi", salt_from)


def _together(
    found: DataFrame, totals: DataFrame, contexts: int, share: float
) -> tuple[DataFrame, DataFrame]:
    """``word, entity, together, contexts`` within documents, and ``entity, entity_n``.

    Entities of fewer than ``contexts`` texts cannot be disclosed and are left
    out. Nor can a word disclose one of which less than ``share`` of all
    occurrences lie in texts with such entities: these words, among them all
    that are common, are left out before words meet entities.
    """
    held = found.select("text_key", F.explode("entities").alias("entity")).distinct()
    several = (
        held.groupBy(F.col("entity").alias("_entity")).agg(F.count(F.lit(1)).alias("_texts"))
        .where(F.col("_texts") >= contexts)
    )
    held = join_by_key(held, "entity", several, "_entity", "inner", ["text_key"]).select("text_key", "entity")
    held = cut_lineage(held)
    texts = found.join(held.select("text_key").distinct(), "text_key", "left_semi")
    rows = texts.select("text_key", F.explode("every").alias("x")).select("text_key", "x.*")
    inside = rows.groupBy("word").agg(F.count(F.lit(1)).alias("inside")).where(F.col("inside") >= contexts)
    candidates = cut_lineage(
        inside.join(totals, "word").where(F.col("inside") >= share * F.col("occurrences")).select("word")
    )
    words = (
        _among(rows, "word", candidates, ["text_key", "context"])
        .groupBy("text_key", "word", "context")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pairs = words.join(held, "text_key").groupBy("word", "entity").agg(
        F.sum("n").alias("together"),
        F.least(F.count_distinct("context"), F.count_distinct("text_key")).alias("contexts"),
    )
    sizes = texts.groupBy("text_key").agg(F.sum(F.size("every")).alias("n"))
    return pairs, sizes.join(held, "text_key").groupBy("entity").agg(F.sum("n").alias("entity_n"))


def disclosing_words(
    documents: DataFrame, found: DataFrame, contexts: int = CONTEXTS, share: float = SHARE, bits: float = BITS
) -> DataFrame:
    """``word, entity`` where the word tells enough about the entity.

    ``found``: the words near entities, and all words and entities, of each row.
    Counts are summed in the tasks before they are shuffled.
    """
    near = found.select(F.explode("near").alias("x")).select("x.*")
    pairs = (
        near.groupBy("word", "entity", "context").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("word", "entity")
        .agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("contexts"))
    )
    counts = documents.select("text").mapInArrow(_count_words, "word bigint, n bigint")
    totals = cut_lineage(counts.groupBy("word").agg(F.sum("n").alias("occurrences")))
    every = totals.agg(F.sum("occurrences").alias("all_words"))
    given = F.col("together") / F.col("occurrences")
    told = F.log2(given * F.col("all_words") / F.col("entity_n"))

    def telling(pairs: DataFrame, entities: DataFrame) -> DataFrame:
        return (
            pairs.where(F.col("contexts") >= contexts)
            .join(totals, "word")
            .join(entities, "entity")
            .withColumn("all_words", every.scalar())
            .where((given >= share) & (told >= bits))
            .select("word", "entity")
        )

    close = telling(pairs, near.groupBy("entity").agg(F.count(F.lit(1)).alias("entity_n")))
    return close.union(telling(*_together(found, totals, contexts, share))).distinct()


def find_spans(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, text_key, spans, terms`` for every row: pattern spans and all disclosing words."""
    keyed = _keyed(documents)
    key = [keyed.schema["doc_id"], keyed.schema["text_key"]]
    schema = T.StructType(
        [key[1], T.StructField("near", _NEAR), T.StructField("every", _EVERY), T.StructField("entities", T.ArrayType(T.LongType()))]
    )
    found = cut_lineage(keyed.mapInArrow(_find(reach), schema).where(F.size("entities") > 0))
    disclosing = cut_lineage(disclosing_words(documents, found).select("word").distinct())
    schema = T.StructType([*key, T.StructField("spans", _SPANS), T.StructField("terms", _SPANS)])
    if disclosing.count() <= SENT_WORDS:
        sent = np.sort(disclosing.toArrow().column("word").to_numpy())
        return keyed.mapInArrow(_term_spans(sent), schema)
    places = keyed.mapInArrow(
        _word_places,
        T.StructType(
            [*key, T.StructField("word", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
        ),
    )
    term = F.struct(F.lit(len(KINDS) - 1).cast("tinyint").alias("kind"), "start", "end")
    added = (
        join_by_key(places, "word", disclosing.withColumnRenamed("word", "_word"), "_word", "inner", ["text_key", "start"])
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        .agg(F.collect_set(term).alias("added"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return (
        keyed.mapInArrow(_term_spans(np.zeros(0, np.int64)), schema)
        .join(added, same, "left")
        .select("doc_id", "text_key", "spans", F.coalesce("added", F.array().cast(_SPANS)).alias("terms"))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def personal_data_report(documents: DataFrame) -> DataFrame:
    found = find_spans(documents)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *[count(k) for k in range(4)],
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
        _joined(F.concat("spans", "terms")).alias("spans"),
    )


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with spans replaced by the names of their kinds; overlapping ones become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _sanitise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        terms = batch.column(2).to_pylist()
        new = []
        for text, added in zip(texts, terms, strict=True):
            if text is None:
                new.append(None)
                continue
            extra = [(s["kind"], s["start"], s["end"]) for s in added or []]
            new.append(mask(text, base_spans(text) + extra))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], ["row", "new_text"])


def sanitise(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data and disclosing words masked in ``text``."""
    terms = find_spans(documents).where(F.size("terms") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "terms"
    ).dropDuplicates(["_id", "_key"])
    names = documents.columns
    rows = documents.select(F.struct(*names).alias("row"), "doc_id", "text", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    met = rows.join(terms, same, "left").select("row", "text", "terms")
    schema = T.StructType([met.schema["row"], T.StructField("new_text", T.StringType())])
    new = met.mapInArrow(_sanitise, schema)
    replaced = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("bigint")}
    return new.select(*[replaced.get(n, F.col("row")[n]).alias(n) for n in names])
