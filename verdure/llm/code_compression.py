"""Vector codes from one codebook per part of the vector, by ball k-means in integers.

Components become ``floor(SCALE * x)`` and vectors are cut into ``PARTS`` equal
parts. All distances are squared and whole numbers, so ties are real ties and
go to the lower entry.

The first assignment compares with every entry. Later ones start from the
assignment before. The parts of an entry are its ball: its radius is the largest
distance that was met, plus how far the entry has moved since, and only entries
within twice the radius are its neighbours. Parts closer than half the way to the
nearest neighbour are the stable core and are not looked at; the others lie in
rings between the half distances of the sorted neighbours and meet only those up
to their own ring. Since ``4 * own < entry distance`` rules an entry out exactly,
the result is that of the full comparison.

Each round writes vectors and codes as a table; the state of the round before is
dropped then. What comes to the driver is sums per entry, ``ENTRIES`` times the
length of a vector, however many rows there are.

Defined results: rows whose vector is NULL or holds NULL, NaN or infinite
components take no part; nor do vectors of another length than the one with the
smallest id, or of a length that does not divide into the parts. Repeated rows
count as often as they stand. A NULL id sorts last and stays NULL. Fewer rows
than entries give a smaller codebook, an empty table gives none. Numbers are
whole numbers of any size up to ``10**28`` in steps of one; where an error does
not fit a long, the job fails with an ``ArithmeticError`` instead of a wrong number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdure.operators.joins import join_by_key
from verdure.sources.lineage import cut_lineage, drop_state

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Rows whose distances are held at once.
BLOCK = 1 << 14
#: Largest number for which squares of differences are summed in 64 bits.
_NARROW = 1 << 26
_LONG = (1 << 63) - 1


def whole_numbers(rows: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, as Python integers where 64 bits could overflow."""
    with np.errstate(over="ignore"):
        scaled = np.floor(rows.astype(np.float64) * scale)
    if scaled.size == 0 or np.abs(scaled).max() < _NARROW:
        return scaled.astype(np.int64)
    # Doubles that large are whole numbers, so nothing is lost by the order.
    exact = [int(s) if np.isfinite(s) else int(x) * scale for s, x in zip(scaled.flat, rows.flat, strict=True)]
    if max(map(abs, exact)) >= 10**28:
        raise ArithmeticError("components beyond 10**28 are not supported")
    return np.array(exact, dtype=object).reshape(rows.shape)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    diff = a - b
    return (diff * diff).sum(axis=-1)


@dataclass
class Codebooks:
    """``entries[p]`` is the list of entries of part ``p``, each a list of integers."""

    entries: list[list[list[int]]]
    #: Bound of the squared radius of each entry's ball, before the first round none.
    radii: list[list[int]] | None = None
    _books: list[np.ndarray] = field(default_factory=list, repr=False)

    def book(self, p: int) -> np.ndarray:
        if not self._books:
            wide = any(abs(x) >= _NARROW for part in self.entries for e in part for x in e)
            kind = object if wide else np.int64
            self._books = [np.array(part, dtype=kind) for part in self.entries]
        return self._books[p]

    def neighbours(self, p: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each entry, those within twice its radius and their squared distances, by distance."""
        book, out = self.book(p), []
        for i, radius in enumerate(self.radii[p]):
            away = _squares(book, book[i])
            near = np.array([j for j in range(len(book)) if j != i and away[j] <= 4 * radius], dtype=np.int64)
            near = near[np.argsort(away[near], kind="stable")]
            out.append((near, away[near]))
        return out

    def sha256(self) -> str:
        flat = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()


def nearest_of_all(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance by full comparison."""
    codes = np.zeros(len(part), dtype=np.int64)
    best = _squares(part, book[0])
    for j in range(1, len(book)):
        away = _squares(part, book[j])
        nearer = np.asarray(away < best, dtype=bool)
        codes[nearer], best = j, np.where(nearer, away, best)
    return codes, best


def nearest_in_balls(
    part: np.ndarray, codes: np.ndarray, book: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``nearest_of_all``, from the codes of the round before; also the comparisons made."""
    own = _squares(part, book[codes])
    new, best, made = codes.copy(), own.copy(), len(part)
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(book) + 1))
    for i, (others, away) in enumerate(near):
        ball = order[bounds[i] : bounds[i + 1]]
        if not len(ball) or not len(others):
            continue
        ball = ball[np.asarray(4 * own[ball] >= away[0], dtype=bool)]  # without the stable core
        ball = ball[np.argsort(own[ball], kind="stable")]
        reach = 4 * own[ball]
        for j, apart in zip(others, away, strict=True):
            ring = ball[np.searchsorted(reach, apart, side="left") :]
            if not len(ring):
                break
            distance = _squares(part[ring], book[j])
            made += len(ring)
            better = np.asarray((distance < best[ring]) | ((distance == best[ring]) & (j < new[ring])), dtype=bool)
            new[ring[better]], best[ring[better]] = j, distance[better]
    return new, best, made


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            numbers = whole_numbers(_vectors(part.column("vector")))
            yield part, numbers.reshape(len(numbers), PARTS, -1)


def _codes(part: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(part.column("codes").to_pylist())
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, PARTS).astype(np.int64)


def _assign(shared, first: bool):
    """Adds the codes of the nearest entries and the error of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        near = None if first else [books.neighbours(p) for p in range(PARTS)]
        for part, numbers in _blocks(batches):
            old = None if first else _codes(part)
            found = []
            for p in range(PARTS):
                if first:
                    found.append(nearest_of_all(numbers[:, p], books.book(p)))
                else:
                    found.append(nearest_in_balls(numbers[:, p], old[:, p], books.book(p), near[p])[:2])
            codes = np.column_stack([c for c, _ in found]).astype(np.uint8)
            errors = [sum(int(e) for e in row) for row in zip(*(e for _, e in found), strict=True)]
            if errors and max(errors) > _LONG:
                raise ArithmeticError("an error does not fit a long")
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("vec_id", "label", "vector")),
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(errors, pa.int64()),
                ],
                ["vec_id", "label", "vector", "codes", "error"],
            )

    return run


def _sums(shared):
    """Per task: sum of each component of each entry's parts, their number and largest distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Codebooks = shared.value
        held: dict[tuple[int, int], list] = {}
        for part, numbers in _blocks(batches):
            codes = _codes(part)
            for p in range(PARTS):
                away = _squares(numbers[:, p], books.book(p)[codes[:, p]])
                for e in np.unique(codes[:, p]):
                    mine = codes[:, p] == e
                    total = [int(x) for x in numbers[mine, p].sum(axis=0)]
                    old = held.setdefault((p, int(e)), [0, 0, [0] * len(total)])
                    old[0] += int(mine.sum())
                    old[1] = max(old[1], int(away[mine].max()))
                    old[2] = [a + b for a, b in zip(old[2], total, strict=True)]
        rows = [
            (p, e, k, Decimal(x), n, Decimal(r)) for (p, e), (n, r, total) in held.items() for k, x in enumerate(total)
        ]
        wide = pa.decimal128(38, 0)
        types = (pa.int32(), pa.int32(), pa.int32(), wide, pa.int64(), wide)
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "entry", "place", "total", "n", "far"]
        )

    return run


def _ceil_root(x: int) -> int:
    root = isqrt(x)
    return root + (root * root < x)


def _moved(books: Codebooks, state: DataFrame) -> Codebooks:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    shared = state.sparkSession.sparkContext.broadcast(books)
    schema = "part int, entry int, place int, total decimal(38,0), n bigint, far decimal(38,0)"
    sums = (
        state.select("vector", "codes")
        .mapInArrow(_sums(shared), schema)
        .groupBy("part", "entry", "place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("far").alias("far"))
        .collect()
    )
    entries = [[list(e) for e in part] for part in books.entries]
    far = [[0] * len(part) for part in entries]
    for r in sums:
        entries[r.part][r.entry][r.place] = int(r.total) // r.n
        far[r.part][r.entry] = int(r.far)
    radii = [
        [
            (_ceil_root(far[p][e]) + _ceil_root(sum((a - b) ** 2 for a, b in zip(old, entries[p][e], strict=True)))) ** 2
            for e, old in enumerate(part)
        ]
        for p, part in enumerate(books.entries)
    ]
    return Codebooks(entries, radii)


def _usable(embeddings: DataFrame, column: str, id_column: str, label: str) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vector = F.col(column)
    rows = embeddings.where(vector.isNotNull() & ~F.exists(vector, bad)).select(
        F.col(id_column).alias("vec_id"), F.col(label).cast("string").alias("label"), vector.alias("vector")
    )
    return rows.where((F.size("vector") > 0) & (F.size("vector") % PARTS == 0))


def compress(
    embeddings: DataFrame, column: str = "embedding", id_column: str = "vec_id", label: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, vector, codes, error`` of each usable row (a written table), and the codebooks."""
    rows = _usable(embeddings, column, id_column, label)
    order = (F.col("vec_id").asc_nulls_last(), F.col("vector"))
    first = rows.orderBy(*order).limit(1).collect()
    length = len(first[0].vector) if first else 0
    rows = rows.where(F.size("vector") == length)
    start = [r.vector for r in rows.orderBy(*order).limit(ENTRIES).collect()]
    numbers = whole_numbers(np.array(start, dtype=np.float64).reshape(len(start), length))
    cut = numbers.reshape(len(start), PARTS, -1) if start else numbers.reshape(0, PARTS, 0)
    books = Codebooks([[[int(x) for x in cut[e, p]] for e in range(len(start))] for p in range(PARTS)])

    added = [T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])
    context = embeddings.sparkSession.sparkContext
    state = rows
    for turn in range(ROUNDS + 1):
        before = state
        state = cut_lineage(before.mapInArrow(_assign(context.broadcast(books), turn == 0), schema))
        if turn:
            drop_state(before)
        if turn < ROUNDS:
            books = _moved(books, state)
    return state, books


def code_report(embeddings: DataFrame) -> DataFrame:
    state, books = compress(embeddings)
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    rows = state.select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", key.alias("_key")
    )
    totals = state.groupBy(key.alias("_label")).agg(F.sum("error").alias("label_error"))
    return join_by_key(rows, "_key", totals, "_label", "inner").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
