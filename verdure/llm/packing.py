"""Best-fit packing of documents into token sequences by bin completion.

Tokenising and placing run on Spark; what is searched is small whatever the
corpus: a table of how many pieces there are of each length (at most
``capacity`` rows). Pieces of equal length are interchangeable, so a filling of
a sequence is a set of lengths, and one decision fills as many sequences with it
as the counts allow.

The search is bin completion: around the largest piece left it enumerates
fillings that no other filling dominates, best fit first, and branches over
them. A branch is cut when the waste so far already rules out fewer sequences
than the incumbent. A filling is used as often as counts and bound allow, and on
the way back for half as many sequences, and half of those. The first incumbent
is best-fit decreasing. The search ends when the incumbent meets the lower
bound, or after ``nodes`` steps, with the best packing found. Around one piece it
looks at ``FILLINGS`` fillings at most, and at no more once it has ``PERFECT``
and one of them leaves no room. So a packing above the bound may not be the
smallest one, but every piece is placed in every case.

The packing is turned into runs of ranks per length, at most ``capacity``
decisions of fewer than 64 lengths each, and every piece finds its sequence by
its rank among the pieces of its length, which a range partitioning counts.

Defined results: NULL and empty texts are the separator token alone; repeated
rows and NULL ids are documents like others; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.llm.words import ranges
from verdure.operators.identity import assign_ids
from verdure.sources.lineage import cut_lineage

CAPACITY = 2048
SEPARATOR = 0
NODES = 20_000
#: Fillings that are looked at around one piece before the search moves on.
FILLINGS = 400
#: With so many undominated ones, one of them without waste, no more are looked for.
PERFECT = 8
#: Words whose ids a worker remembers: about 250 MB.
HELD_WORDS = 1_500_000
#: Bytes of text that are split at once; a longer text is taken whole.
TEXT_BYTES = 2 << 20

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first
Packing = list[tuple[Filling, int]]  # a filling and the number of sequences that have it


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Packing:
    """Longest pieces first, each into the fullest sequence that takes it; equal ones at once."""
    open_: dict[int, list[list]] = {}  # room left -> [filling, sequences]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = next((r for r in range(size, capacity) if open_.get(r)), None)
            if room is None:
                each = capacity // size
                for many, bins in ((each, left // each), (left % each, 1)):
                    if many and bins:
                        open_.setdefault(capacity - many * size, []).append([((size, many),), bins])
                break
            filling, bins = open_[room].pop()
            each = min(room // size, left)
            take = min(bins, left // each)
            if bins > take:
                open_[room].append([filling, bins - take])
            open_.setdefault(room - each * size, []).append([(*filling, (size, each)), take])
            left -= each * take
    return [(tuple(f), n) for group in open_.values() for f, n in group if n]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Fewest sequences that any packing needs (bound of Martello and Toth)."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    held = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in counts.items():
        held[s] = n
    number = np.cumsum(held)
    volume = np.cumsum(held * np.arange(capacity + 1))
    half = capacity // 2
    for k in range(half + 1):
        alone = int(number[capacity] - number[capacity - k])
        large = int(number[capacity - k] - number[half])
        room = large * capacity - int(volume[capacity - k] - volume[half])
        small = int(volume[half] - (volume[k - 1] if k else 0))
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def fillings(size: int, counts: np.ndarray, capacity: int, bound: int = FILLINGS) -> list[Filling]:
    """Undominated fillings around one piece of ``size``, least waste first.

    A filling is dominated if another piece would still fit, or if one of its
    pieces could give way to a longer one.
    """
    left = counts.copy()
    left[size] -= 1
    sizes = [int(s) for s in np.flatnonzero(left[: capacity - size + 1]) if s][::-1]
    found: list[tuple[int, tuple]] = []
    seen = 0

    rising = np.array(sizes[::-1], dtype=np.int64)
    # For each room the place of the longest size that fits.
    fits = (len(sizes) - np.searchsorted(rising, np.arange(capacity + 1), "right")).tolist()

    def dominated(parts: list[tuple[int, int]], room: int) -> bool:
        if room == 0 or not len(rising):
            return False
        used = dict(parts)
        for low, high in [(0, room), *((p, p + room) for p in used)]:
            between = rising[np.searchsorted(rising, low, "right") : np.searchsorted(rising, high, "right")]
            if any(used.get(s, 0) < left[s] for s in between.tolist()):
                return True
        return False

    stack = [(0, capacity - size, [])]
    while stack and seen < bound:
        at, room, parts = stack.pop()
        at = max(at, fits[room])
        if at == len(sizes):
            seen += 1
            if not dominated(parts, room):
                found.append((room, tuple(parts)))
                if room == 0 and len(found) >= PERFECT:
                    break
            continue
        s = sizes[at]
        most = min(int(left[s]), room // s)
        for many in range(0, most + 1):  # the largest number is looked at first
            stack.append((at + 1, room - many * s, [*parts, (s, many)] if many else parts))
    found.sort(key=lambda f: f[0])
    out = []
    for _, parts in found:
        merged = dict(parts)
        merged[size] = merged.get(size, 0) + 1
        out.append(tuple(sorted(merged.items(), reverse=True)))
    return out


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Packing:
    """The packing with the fewest sequences that the search finds."""
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(n for _, n in best)
    least = lower_bound(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    left = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in counts.items():
        left[s] = n
    path: list[tuple[Filling, int]] = []
    choices: list[Iterator[tuple[Filling, int]]] = []
    waste = used = steps = 0

    def largest() -> int:
        full = np.flatnonzero(left)
        return int(full[-1]) if len(full) else 0

    def tried(top: int) -> Iterator[tuple[Filling, int]]:
        return iter([(f, sum(counts.values())) for f in fillings(top, left, capacity)])

    if fewest > least:
        choices.append(tried(largest()))
    while choices and fewest > least and steps < nodes:
        steps += 1
        filling, most = next(choices[-1], (None, 0))
        if filling is None:
            choices.pop()
            if path:
                undone, times = path.pop()
                for s, n in undone:
                    left[s] += n * times
                waste -= (capacity - sum(s * n for s, n in undone)) * times
                used -= times
                if times > 1:
                    # The same filling again, for fewer sequences, before the next one.
                    choices[-1] = chain([(undone, times // 2)], choices[-1])
            continue
        room = capacity - sum(s * n for s, n in filling)
        times = min(most, *(int(left[s]) // n for s, n in filling))
        # One sequence fewer than the incumbent leaves so much waste in all.
        allowed = (fewest - 1) * capacity - total
        if waste + room * times > allowed:
            times = int((allowed - waste) // room) if room and allowed > waste else 0
            if times == 0 and left.sum() > sum(n for _, n in filling):
                continue
            times = max(times, 1)
        for s, n in filling:
            left[s] -= n * times
        waste += room * times
        used += times
        path.append((filling, times))
        top = largest()
        if top == 0:
            if used < fewest:
                best, fewest = list(path), used
            choices.append(iter(()))
        elif used >= fewest - 1:
            choices.append(iter(()))
        else:
            choices.append(tried(top))
    return best


# Letters whose case and form never depend on their neighbours, and lines of them and ASCII.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f"
_PLAIN = re.compile(f"[\t\n\r\x20-\x7e{_LETTERS}]*")
# The endings that the vocabulary splits off behind an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# Classes of bytes in lower-case plain text; beyond ASCII there are only letters.
_BLANK, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[97:123] = _CLASS[128:] = _LETTER
_CLASS[48:58] = _DIGIT


def plain_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that the vocabulary splits plain lower-case text into.

    Runs of letters, runs of marks, single digits, and an apostrophe with an
    ending where no other mark stands before it.
    """
    kind = _CLASS[data]
    begins = np.ones(len(data), dtype=bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    quotes = np.flatnonzero((data == 0x27) & begins)
    if len(quotes):
        padded = np.append(data, np.zeros(2, dtype=np.uint8))
        one, two = padded[quotes + 1], padded[quotes + 2]
        size = np.zeros(len(quotes), dtype=np.int64)
        for ending in _ENDINGS:
            same = one == ord(ending[0])
            if len(ending) == 2:
                same &= two == ord(ending[1])
            size[same & (size == 0)] = len(ending)
        quotes, size = quotes[size > 0], size[size > 0]
        begins[quotes + 1] = False
        behind = quotes + 1 + size
        begins[behind[behind < len(data)]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    kept = kind[starts] != _BLANK
    return starts[kept], ends[kept]


class WordIds:
    """Token ids of texts through a memory of the ids of words.

    The vocabulary splits a text into words, single digits and marks before it
    encodes, and never looks across a line end. Texts and lines of plain letters
    and ASCII are split here, many at once, and each different word of them is
    looked up once; new words are encoded many at a time, where each gives ids
    of which only the last ends a word. Other lines, and those that may name a
    special token, are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.ids_of = np.zeros(1 << 16, dtype="<u4")  # ids of all words in a row
        self.bounds = np.zeros(1 << 16, dtype=np.int64)

    def _one(self, piece: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4")

    def _add(self, new: list[str]) -> None:
        for at in range(0, len(new), 256):
            part = new[at : at + 256]
            made = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(made[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                each = [self._one(word) for word in part]
                ids, stops = np.concatenate(each), np.cumsum([len(x) for x in each])
            n = len(self.words)
            begin = int(self.bounds[n])
            while len(self.ids_of) < begin + len(ids):
                self.ids_of = np.append(self.ids_of, np.zeros_like(self.ids_of))
            while len(self.bounds) <= n + len(part):
                self.bounds = np.append(self.bounds, np.zeros_like(self.bounds))
            self.ids_of[begin : begin + len(ids)] = ids
            self.bounds[n + 1 : n + 1 + len(part)] = begin + stops
            self.words.update(zip(part, range(n, n + len(part)), strict=True))

    def _plain_ids(self, raw: bytes, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain lower-case text, and the first id behind each of the cuts."""
        data = np.frombuffer(raw, dtype=np.uint8)
        starts, ends = plain_words(data)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(cuts), dtype=np.int64)
        offsets = pa.py_buffer(np.append(0, np.cumsum(ends - starts)).astype(np.int64))
        places, _ = ranges(starts, ends)
        coded = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(data[places])).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in different if w not in self.words]
        if new:
            if len(self.words) + len(new) > HELD_WORDS:
                self._forget()
                new = different
            self._add(new)
        which = np.array([self.words[w] for w in different], dtype=np.int64)[coded.indices.to_numpy()]
        begin, end = self.bounds[which], self.bounds[which + 1]
        taken, _ = ranges(begin, end)
        before = np.append(0, np.cumsum(end - begin))
        return self.ids_of[taken], before[np.searchsorted(starts, cuts)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found: list[list] = []  # per text: numbers of plain parts, or ids
        plain: list[bytes] = []
        for text in texts:
            if "<|" not in text and _PLAIN.fullmatch(text):
                found.append([len(plain)])
                plain.append(text.lower().encode())
                continue
            parts: list = []
            for line in text.split("\n"):
                if "<|" not in line and _PLAIN.fullmatch(line):
                    parts.append(len(plain))
                    plain.append(line.lower().encode())
                else:
                    parts.append(self._one(line))
            found.append(parts)
        cuts = np.cumsum([0, *(len(x) + 1 for x in plain)])
        ids, at = self._plain_ids(b"\n".join(plain), cuts)
        bounds = at.tolist()
        pick = lambda p: ids[bounds[p] : bounds[p + 1]] if isinstance(p, int) else p
        return [pick(x[0]) if len(x) == 1 else np.concatenate([pick(p) for p in x]) for x in found]


_READY: dict[str, WordIds] = {}


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _READY:
            _READY[path] = WordIds(path)
        words = _READY[path]
        separator = np.array([SEPARATOR], dtype="<u4")
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            groups = np.cumsum(sizes) // TEXT_BYTES
            for at, end in zip(*_groups(groups), strict=True):
                part = batch.slice(at, end - at)
                found = words.ids([t or "" for t in part.column(1).to_pylist()])
                flat = np.concatenate([x for ids in found for x in (ids, separator)])
                total = np.array([len(x) + 1 for x in found])
                pieces = -(-total // capacity)
                row = np.repeat(np.arange(len(found)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(total[row] - start, capacity)
                begin = (np.cumsum(total) - total)[row] + start
                raw = memoryview(flat.astype("<u4", copy=False)).cast("B")
                check = [
                    zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(begin.tolist(), (begin + length).tolist(), strict=True)
                ]
                columns = [
                    part.column(0).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(check, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    bounds = pa.array(np.append(begin, len(flat)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(flat.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _groups(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal numbers."""
    starts = np.flatnonzero(np.diff(keys, prepend=-1)).tolist()
    return starts, [*starts[1:], len(keys)] if starts else []


def token_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, the separator at its end."""
    source = documents.select("doc_id", "text")
    fields = [
        source.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return source.mapInArrow(_pieces(path, capacity, with_ids), T.StructType(fields))


def _runs(packing: Packing, before: dict[int, int]) -> tuple[np.ndarray, ...]:
    """Runs of ranks over all pieces, in order of length: where each starts, the first
    sequence, pieces per sequence, the offset of the first and the length."""
    given = dict.fromkeys(before, 0)
    rows = []
    sequence = 0
    for filling, times in packing:
        offset = 0
        for size, many in filling:
            rows.append((before[size] + given[size], sequence, many, offset, size))
            given[size] += many * times
            offset += size * many
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else ()


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, sequence, many, offset, size = shared.value
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(start, rank, "right") - 1
            inside = rank - start[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(batch.num_columns - 1)),
                    pa.array(sequence[at] + inside // many[at]),
                    pa.array(offset[at] + inside % many[at] * size[at]),
                ],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``) with ``sequence_id`` and ``offset``."""
    pieces = cut_lineage(pieces)
    # At most `capacity` rows.
    counts = {
        r["length"]: r["n"]
        for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    before, total = {}, 0
    for size in sorted(counts):
        before[size] = total
        total += counts[size]
    runs = _runs(complete(counts, capacity, nodes), before)
    fields = [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    ranked = assign_ids(pieces, ["length", "doc_id", "piece"], start=0, into="rank")
    if not runs:
        return ranked.drop("rank").withColumns(
            {n: F.lit(None).cast("bigint") for n in ("sequence_id", "offset")}
        )
    shared = pieces.sparkSession.sparkContext.broadcast(runs)
    return ranked.mapInArrow(_place(shared), T.StructType(fields))


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(documents, path, capacity), capacity)
