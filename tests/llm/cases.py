"""Awkward documents: NULLs, empty and long texts, copies, repeated rows, clashing columns."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id string, row int, score string, text_key int, hash int, label string, tree int, spans int, _id int"
)
OTHER = ("x", 1, "y", 2, 3, "z", 4, 5, 6)


def prose(seed: int, n: int, words: int = 400) -> list[str]:
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abcdefgé')}{rng.choice(['la', 'Mo', 'ti', 'ß'])}{i}" for i in range(words)]
    return [rng.choice(vocabulary) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    """(doc_id, text) with all doc_ids different but for the NULLs."""
    rng = random.Random(3)
    base = prose(1, 300)
    shared = prose(2, 80)
    out: list[tuple[int | None, str | None]] = [
        (1, None),
        (2, ""),
        (3, " \t\r\n "),
        (4, "one"),
        (5, "one"),
        (6, "Three short words"),
        (7, "three short  words"),
        (10, " ".join(base)),
        (11, "\n".join(base)),
        (12, " ".join(base).upper()),
        (40, " ".join(prose(8, 200) + shared)),
        (41, " ".join(shared + prose(9, 150))),
        (42, " ".join(prose(10, 20) + shared[:50] + prose(11, 20))),
        (43, " ".join(prose(12, 20) + shared[:49] + prose(13, 20))),
        (50, "same word " * 3000),
        (51, "same word " * 40),
        (60, " ".join(prose(14, 30_000, 5000))),
        (61, "x" * 200_000),
    ]
    for i in range(20, 40):
        near = list(base)
        for _ in range(rng.choice((1, 3, 6, 12))):
            near[rng.randrange(len(near))] = f"new{i}"
        out.append((i, " ".join(near)))
    return out


def documents(spark, rows=None):
    """The texts with a NULL id, a row that stands twice and columns with clashing names."""
    given = texts() if rows is None else list(rows)
    if rows is None:
        given += [given[7], (None, "a text without an id, a few words long"), (None, None)]
    full = [(i, t, "en", "s", len(t or ""), *OTHER) for i, t in given]
    return spark.createDataFrame(full, COLUMNS)


def pairs(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x if x is not None else 0) for x in r])
