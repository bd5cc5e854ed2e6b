"""Fill-in-the-middle order of whole texts, with chunks that content defines.

A unit is a run of ASCII letters or any other single code point. Two units of
each text, picked by a hash of its id, end the prefix and the middle. To find
them, a rolling hash over the last ``WINDOW`` bytes cuts a text into chunks, so
that passages which documents share give the same chunks wherever they stand.
What a chunk adds (units, code points, whether it starts and ends in a letter) is
remembered under its very bytes; a chunk met again is only looked up, and the
lookup compares the bytes. Sums over the chunks, less one where a run of letters
goes on across an edge, give the units of the text and the chunk of each cut;
only that chunk is looked at unit by unit.

Texts are independent: nothing is shuffled. The memory is a task's own, holds at
most ``CACHE_BYTES`` and starts anew when full, which changes no result.

Defined results: a NULL or empty text is empty and plain; a NULL id counts as an
empty one in the hash; repeated rows give equal rows; an empty table gives none.
Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.llm.words import text_chunks

WINDOW = 16
#: A place in so many ends a chunk.
CHUNK = 512
#: Bytes of chunks that a task remembers.
CACHE_BYTES = 16 << 20
#: Of 100 documents, those left as they are, and of the others those with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
#: The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_GEAR = np.random.default_rng(11).integers(0, 1 << 16, 256, dtype=np.uint16)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = np.ones(256, dtype=bool)
_LEAD[128:192] = False


def chunk_edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of chunks and of texts in ``data``, with 0 in front; empty texts add none.

    A text's first ``WINDOW`` bytes have no edge, so edges depend on its own bytes alone.
    """
    rolling = np.zeros(len(data), dtype=np.uint16)
    gear = _GEAR[data]
    for k in range(min(WINDOW, len(data))):
        rolling[k:] += gear[: len(data) - k] << np.uint16(k)
    found = np.flatnonzero(rolling < (1 << 16) // CHUNK) + 1
    found = found[found < len(data)]
    found = found[_LEAD[data[found]]]
    begin = offsets[np.searchsorted(offsets, found, side="right") - 1]
    found = found[found - begin >= WINDOW]
    return np.unique(np.concatenate([offsets, found]))


def _unit_starts(data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Marks the first byte of each unit; units do not run across ``firsts``."""
    letter = _LETTER[data]
    runs = letter.copy()
    runs[1:] &= ~letter[:-1]
    runs[firsts] = letter[firsts]
    return runs | (~letter & _LEAD[data])


class ChunkSums:
    """Units, code points and letters at both ends of chunks, remembered by their bytes."""

    def __init__(self, limit: int = CACHE_BYTES) -> None:
        self.limit = limit
        self.held: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.size = 0
        self.n_counted = 0  # chunks that were not remembered

    def of(self, chunks: list[bytes]) -> np.ndarray:
        """Rows (units, code points, starts in a letter, ends in a letter)."""
        new = list(dict.fromkeys(c for c in chunks if c not in self.held))
        if new:
            if self.size > self.limit:
                self.held, self.size = {}, 0
                new = list(dict.fromkeys(chunks))
            data = np.frombuffer(b"".join(new), dtype=np.uint8)
            ends = np.cumsum([len(c) for c in new])
            firsts = np.append(0, ends[:-1])
            table = zip(
                np.add.reduceat(_unit_starts(data, firsts), firsts, dtype=np.int64).tolist(),
                np.add.reduceat(_LEAD[data], firsts, dtype=np.int64).tolist(),
                _LETTER[data[firsts]].tolist(),
                _LETTER[data[ends - 1]].tolist(),
                strict=True,
            )
            self.held.update(zip(new, table, strict=True))
            self.size += len(data)
            self.n_counted += len(new)
        return np.array([self.held[c] for c in chunks], dtype=np.int64).reshape(-1, 4)


class TextUnits:
    """Units of several texts in a row, held as sums over their chunks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sums: ChunkSums) -> None:
        self.data, self.offsets = data, offsets
        self.edges = chunk_edges(data, offsets)
        raw = data.tobytes()
        cuts = self.edges.tolist()
        table = sums.of([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        self.raw = raw
        # A run of letters that goes on across an edge inside a text is one unit.
        self.joined = np.zeros(len(table), dtype=bool)
        self.joined[1:] = (table[:-1, 3] > 0) & (table[1:, 2] > 0)
        first_chunk = np.searchsorted(self.edges, offsets[:-1][np.diff(offsets) > 0])
        self.joined[first_chunk] = False
        self.units = np.append(0, np.cumsum(table[:, 0] - self.joined))
        self.chars = np.append(0, np.cumsum(table[:, 1]))
        at = np.searchsorted(self.edges, offsets)
        self.before, self.before_chars = self.units[at], self.chars[at]

    def count(self, i: int) -> int:
        return int(self.before[i + 1] - self.before[i])

    def end_of(self, i: int, n: int) -> tuple[int, int]:
        """Byte in ``data`` and code point in text ``i`` after its first ``n`` units."""
        if n >= self.count(i):
            return int(self.offsets[i + 1]), int(self.before_chars[i + 1] - self.before_chars[i])
        target = self.before[i] + n
        chunk = int(np.searchsorted(self.units, target, side="right")) - 1
        begin, end = self.edges[chunk], self.edges[chunk + 1]
        part = self.data[begin:end]
        starts = _unit_starts(part, np.zeros(1, dtype=np.int64))
        starts[0] &= not self.joined[chunk]
        at = int(np.flatnonzero(starts)[target - self.units[chunk]])
        chars = self.chars[chunk] - self.before_chars[i] + np.count_nonzero(_LEAD[part[:at]])
        return int(begin) + at, int(chars)


_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def _reorder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = ChunkSums()
    p, s, m = _MARKS
    for batch in batches:
        for row, end, data, offsets in text_chunks(batch.column("text")):
            part = batch.slice(row, end - row)
            units = TextUnits(data, offsets, sums)
            rows = zip(*(part.column(c).to_pylist() for c in ("h1", "h2", "form")), strict=True)
            n, prefix, middle, output = [], [], [], []
            for i, (h1, h2, form) in enumerate(rows):
                count = units.count(i)
                n.append(count)
                a, z = int(offsets[i]), int(offsets[i + 1])
                if form == "plain":
                    prefix.append(None)
                    middle.append(None)
                    output.append(units.raw[a:z])
                    continue
                low, high = sorted((h1 % (count + 1), h2 % (count + 1)))
                (b, b_chars), (c, c_chars) = units.end_of(i, low), units.end_of(i, high)
                head, body, tail = units.raw[a:b], units.raw[b:c], units.raw[c:z]
                prefix.append(b_chars)
                middle.append(c_chars - b_chars)
                order = (p, head, s, tail) if form == "psm" else (s, tail, p, head)
                output.append(b"".join((*order, m, body)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    part.column("form"),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def fill_in_middle(documents: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each document.

    ``output`` is the text with its parts in the order of ``form``: ``psm``,
    ``spm`` or ``plain``. A text that holds a mark stays plain.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("bigint")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    form = (
        F.when((F.col("text") == "") | marked | (number(3) % 100 >= 100 - PLAIN_PERCENT), "plain")
        .when(number(4) % 100 < SUFFIX_FIRST_PERCENT, "spm")
        .otherwise("psm")
    )
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", number(1).alias("h1"), number(2).alias("h2"), form.alias("form")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _reorder,
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )


def restored_text(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def fill_in_middle_report(documents: DataFrame) -> DataFrame:
    return fill_in_middle(documents).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
