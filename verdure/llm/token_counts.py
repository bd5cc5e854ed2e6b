"""Token counts that follow edits without encoding whole texts again.

A document's text is split into pre-tokens, which byte-pair encoding never
joins. ``LEAF`` of them make a leaf; a segment tree over the leaves holds the
characters and tokens below each node. Trees are a table, one row per document,
and so are edits. An update walks down each edited document's tree to the leaf
where an edit starts, splits anew from the last boundary that the edit cannot have
moved, and goes on until a new boundary falls on the end of an old leaf behind
the edit: from there on everything is as it was, for the splitting looks ahead
only. Leaves outside are taken over with their sums; trees and texts are given
back for the tables, and documents without edits are not touched.

Defined results: NULL is an empty text; edits outside the text, or inside an
earlier one, are cut to what is left; an empty edit changes nothing. A tree
belongs to an id (NULL is one) and a text; rows that repeat both share it, and
each gets its result. Of several edit lists for one of them any one counts. An
empty table gives none. Other columns need no rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.sources.lineage import cut_lineage

LEAF = 64
#: Characters behind a boundary that the splitting may have looked at.
AHEAD = 2
#: Pre-tokens whose counts a task remembers.
HELD = 1 << 18
Edit = tuple[int, int, str]  # start, end, new text


class Encoder:
    """Splits text and counts the tokens of pre-tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.held: dict[str, int] = {}

    def count(self, pieces: list[str]) -> list[int]:
        held = self.held
        new = {p for p in pieces if p not in held}
        if len(held) + len(new) > HELD:
            held.clear()
            new = set(pieces)
        for piece in new:
            held[piece] = len(self.encoding.encode_ordinary(piece))
        return [held[p] for p in pieces]


class CountTree:
    """Segment tree over the leaves of one text: characters and tokens below each node.

    ``chars`` and ``tokens`` are the nodes in heap order, the root at 1 and the
    leaves from ``width`` on. A leaf is a run of pre-tokens.
    """

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> CountTree:
        width = 1 << max(len(chars) - 1, 0).bit_length()
        nodes = []
        for leaves in (chars, tokens):
            level = leaves + [0] * (width - len(leaves))
            heap = level
            while len(level) > 1:
                level = [x + y for x, y in zip(level[::2], level[1::2], strict=True)]
                heap = level + heap
            nodes.append([0, *heap])
        return cls(*nodes)

    @classmethod
    def of_text(cls, text: str, encoder: Encoder) -> CountTree:
        return cls.of_leaves(*_leaves(encoder.pattern.findall(text), encoder))

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one at the end), and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def edited(self, text: str, edits: list[Edit], encoder: Encoder) -> tuple[CountTree, str, int]:
        """The tree and text after ``edits``, and the characters that were split and encoded anew.

        Edits are in places of ``text``, in order and apart. Around each one the
        new text is split from the start of the leaf that holds the last
        boundary the edit cannot have moved, until a boundary falls on the end
        of an old leaf behind the edit; a region that reaches the next edit goes
        on over it. Leaves outside the regions are taken over with their sums,
        those inside are cut anew, so leaves stay small however often a place
        is edited. The sums above new leaves are made again from them.
        """
        new, edits = _spliced(text, edits)
        if not edits:
            return self, text, 0
        first = self.width
        chars, tokens = self.chars[first:], self.tokens[first:]
        out_chars: list[int] = []
        out_tokens: list[int] = []
        encoded = done = 0  # old leaves that are dealt with
        at = moved = k = 0  # where they end in the old text, and how far that has moved
        while k < len(edits):
            leaf, begin = self.leaf_at(max(edits[k][0] - AHEAD, 0))
            if leaf < done:
                leaf, begin = done, at
            out_chars += chars[done:leaf]
            out_tokens += tokens[done:leaf]
            shift, end = moved, edits[k][1]
            moved += len(edits[k][2]) - (end - edits[k][0])
            k += 1
            here, old, last = begin + shift, begin, leaf
            pieces = []
            for m in encoder.pattern.finditer(new, here):
                pieces.append(m.group())
                here = m.end()
                while True:
                    # Old leaves that end before this boundary.
                    while last < len(chars) and old + moved < here:
                        old += chars[last]
                        last += 1
                    if k < len(edits) and edits[k][0] - AHEAD < old:
                        # The next edit is in or before this leaf: its change counts from here on.
                        end = max(end, edits[k][1])
                        moved += len(edits[k][2]) - (edits[k][1] - edits[k][0])
                        k += 1
                        old, last = begin, leaf
                        continue
                    break
                if old >= end and old + moved == here:
                    break
            else:
                # To the end of the text.
                last = len(chars)
                old = self.length
            counted = _leaves(pieces, encoder)
            encoded += sum(counted[0])
            out_chars += counted[0]
            out_tokens += counted[1]
            done, at = last, old
        out_chars += chars[done:]
        out_tokens += tokens[done:]
        held = [i for i, n in enumerate(out_chars) if n]
        tree = CountTree.of_leaves([out_chars[i] for i in held], [out_tokens[i] for i in held])
        return tree, new, encoded


def _leaves(pieces: list[str], encoder: Encoder) -> tuple[list[int], list[int]]:
    """Characters and tokens of each ``LEAF`` pre-tokens."""
    sizes, counts = list(map(len, pieces)), encoder.count(pieces)
    at = range(0, len(pieces), LEAF)
    return [sum(sizes[i : i + LEAF]) for i in at], [sum(counts[i : i + LEAF]) for i in at]


def _spliced(text: str, edits: list[Edit]) -> tuple[str, list[Edit]]:
    """The new text, and the edits cut to the old one, without those that change nothing."""
    parts, at, kept = [], 0, []
    for start, end, new in edits:
        start = max(at, min(start, len(text)))
        end = max(start, min(end, len(text)))
        if start == end and not new:
            continue
        kept.append((start, end, new))
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]]), kept


_LONG_NUMBER = re.compile("[0-9]{4,}")


def cleaning_edits(text: str) -> list[Edit]:
    """Edits of a cleaning step: long numbers masked, repeated lines taken out."""
    edits, seen, at = [], set(), 0
    for line in text.splitlines(keepends=True):
        key = line.strip()
        if key and key in seen:
            edits.append((at, at + len(line), ""))
        else:
            seen.add(key)
            edits += [(at + m.start(), at + m.end(), "0000") for m in _LONG_NUMBER.finditer(line)]
        at += len(line)
    return edits


_READY: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _READY:
        _READY[path, pattern] = Encoder(path, pattern)
    return _READY[path, pattern]


_EDIT = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())]))
_NODES = pa.list_(pa.int32())
_TREE = "chars array<int>, tokens array<int>"
_EDITS = "edits array<struct<start: int, `end`: int, new: string>>"


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``: a tree belongs to an id and the text that it was made of."""
    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def build_trees(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text_key, chars, tokens``: the segment tree of every row, with its texts encoded whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            trees = [CountTree.of_text(t or "", encoder) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([t.chars for t in trees], _NODES), pa.array([t.tokens for t in trees], _NODES)],
                ["doc_id", "text_key", "chars", "tokens"],
            )

    rows = keyed(documents)
    return rows.mapInArrow(run, f"doc_id {_kind(rows)}, text_key bigint, {_TREE}")


def edits_of_texts(documents: DataFrame, edits_of=cleaning_edits) -> DataFrame:
    """``doc_id, text_key, edits`` of the rows that a cleaning step changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "end", "new")
        for batch in batches:
            found = [[dict(zip(names, e, strict=True)) for e in edits_of(t or "")] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, _EDIT)], ["doc_id", "text_key", "edits"])

    rows = keyed(documents)
    return rows.mapInArrow(run, f"doc_id {_kind(rows)}, text_key bigint, {_EDITS}").where(F.size("edits") > 0)


def _kind(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def update_trees(documents: DataFrame, trees: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """The trees and texts of the edited documents: ``doc_id, text_key, text, chars, tokens, n_edits, n_chars_encoded``.

    ``documents`` holds the texts that the trees were made of, ``edits`` the
    changes, one row for each document that has any. Only those documents are
    joined with their trees, and of their texts only the regions around the
    edits are encoded. A row of ``documents`` gives a row. The result has the new ``text_key``, so it takes the place
    of the old rows in the table of trees.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                tree = CountTree(row["chars"], row["tokens"])
                changes = [(e["start"], e["end"], e["new"]) for e in row["edits"]]
                tree, text, encoded = tree.edited(row["text"] or "", changes, encoder)
                found.append((text, tree.chars, tree.tokens, len(changes), encoded))
            columns = zip(*found, strict=True) if found else [[]] * 5
            kinds = (pa.string(), _NODES, _NODES, pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "old_key", "text", "chars", "tokens", "n_edits", "n_chars_encoded"],
            )

    # A row that stands several times has one tree; the texts travel once, for this join.
    texts = keyed(documents).alias("d")
    changes = edits.dropDuplicates(["doc_id", "text_key"]).alias("e")
    held = trees.dropDuplicates(["doc_id", "text_key"]).alias("t")
    small = held.join(changes, _same_key("t", "e")).select("t.*", "e.edits").alias("s")
    met = texts.join(small, _same_key("d", "s")).select("d.doc_id", "d.text_key", "d.text", "s.chars", "s.tokens", "s.edits")
    schema = (
        f"doc_id {_kind(documents)}, old_key bigint, text string, {_TREE}, n_edits bigint, n_chars_encoded bigint"
    )
    return met.mapInArrow(run, schema).select(
        "doc_id", "old_key", F.xxhash64("text").alias("text_key"), "text", "chars", "tokens", "n_edits", "n_chars_encoded"
    )


def _same_key(a: str, b: str):
    same = F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    return same & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def edited_counts(documents: DataFrame, path: str, pattern: str, edits_of=cleaning_edits) -> DataFrame:
    """Tokens of every text before and after its edits, and the characters encoded for them.

    Trees and edits are tables: the trees are built once and written, the edits
    are found and written, and the update reads both.
    """
    trees = cut_lineage(build_trees(documents, path, pattern))
    edits = cut_lineage(edits_of_texts(documents, edits_of))
    new = cut_lineage(
        update_trees(documents, trees, edits, path, pattern).select(
            "doc_id", F.col("old_key").alias("text_key"), "n_edits", "n_chars_encoded",
            F.get("tokens", F.lit(1)).cast("bigint").alias("tokens_now"),
            F.get("chars", F.lit(1)).cast("bigint").alias("chars_now"),
        ).dropDuplicates(["doc_id", "text_key"])
    )
    rows = trees.select(
        "doc_id", "text_key",
        F.get("tokens", F.lit(1)).cast("bigint").alias("n_tokens"), F.get("chars", F.lit(1)).cast("bigint").alias("n_chars"),
    )
    none = F.lit(0).cast("bigint")
    return rows.alias("t").join(new.alias("n"), _same_key("t", "n"), "left").select(
        "t.doc_id",
        "t.n_tokens",
        F.coalesce("n.n_edits", none).alias("n_edits"),
        F.coalesce("n.tokens_now", "t.n_tokens").alias("n_tokens_edited"),
        F.coalesce("n.chars_now", "t.n_chars").alias("n_chars_edited"),
        F.coalesce("n.n_chars_encoded", none).alias("n_chars_encoded"),
    )
