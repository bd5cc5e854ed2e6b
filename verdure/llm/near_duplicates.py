"""Near-duplicate documents by a MinHash LSH forest, confirmed on full shingle sets.

1. One pass over all texts makes each document's set of word shingles, its size,
   a 128-bit hash of the set and a MinHash signature. Documents with equal sets
   are one class; only its smallest document goes on.
2. The signature is cut into ``TREES`` labels of ``DEPTH`` hash values. For each
   tree the labels are sorted; documents with the longest common prefixes stand
   side by side. Each document meets its nearest neighbours in every order, if
   they share at least ``LEAST`` values: in a sparse region the neighbourhood
   holds everything with that prefix, in a crowded one the depth adapts and only
   deeper prefixes meet.
3. Candidates are confirmed on the full sets of the whole texts, the best of
   each document first; pairs that are connected by then need no look.
4. Crowded regions, where not all members met, are joined through pivots first:
   all members that are not yet connected with the best linked member of the
   region are held against it. It saves step 5 most of its work; what it leaves,
   step 5 finds.
5. Then they are finished exactly: the shingles of each crowded member are
   ordered by how few crowded members have them, and members of different
   components that share a shingle of their prefixes are candidates. A pair that
   is similar enough shares one that leaves room for its overlap in both sets
   (prefix, length and position filter), so none is left out.

Groups are compared through neighbours, pivots and rare shingles, never in all
pairs, and copies of one set, however many, count once.

Defined results: NULL, empty and blank texts have no shingles and no links. A
``doc_id`` is one vertex even if rows repeat it; NULL ids are vertices by text,
larger than all ids, and have a NULL component. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.llm.graph import components
from verdure.llm.words import mix, shingle_sets, signed, split_words, text_chunks
from verdure.operators.identity import assign_ids
from verdure.operators.joins import join_by_key
from verdure.sources.lineage import cut_lineage, drop_state

WIDTH = 4
PERCENT = 80
TREES = 16
DEPTH = 8
LEAST = 3
NEIGHBOURS = 6
BLOCK = 512
_NULL_FROM = 1 << 62
_BY_TEXT = "_by_text"
_RANDOM = np.random.default_rng(5).integers(0, 1 << 63, (2, TREES * DEPTH), dtype=np.uint64)


def signatures(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (big-endian 32 bit) of sets that are not empty, one row each."""
    out = np.empty((len(offsets) - 1, TREES * DEPTH), dtype=">u4")
    factors, shifts = _RANDOM[0] | np.uint64(1), _RANDOM[1]
    for k in range(TREES * DEPTH):
        hashed = (shingles * factors[k] + shifts[k]) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(hashed, offsets[:-1])
    return out


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column(2)):
                flat, bounds = shingle_sets(split_words(data, offsets, lower=True, checked=True), width)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                first = np.zeros(len(sizes), dtype=np.uint64)
                second = np.zeros(len(sizes), dtype=np.uint64)
                labels = np.full(len(sizes), None, dtype=object)
                if len(full):
                    at = np.append(bounds[:-1][full], len(flat))
                    first[full] = np.add.reduceat(mix(flat), at[:-1])
                    second[full] = np.add.reduceat(mix(flat ^ np.uint64(0xABCDEF)), at[:-1])
                    made = signatures(flat, at)
                    labels[full] = [x.tobytes() for x in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        batch.column(1).slice(row, end - row),
                        pa.array(sizes),
                        pa.array(signed(first)),
                        pa.array(signed(second)),
                        pa.array(labels, pa.binary()),
                    ],
                    ["id", "text_key", "n_shingles", "set_a", "set_b", "labels"],
                )

    return run


def _overlaps(width: int):
    """``common`` and ``total`` of the shingle sets of two texts in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[list[np.ndarray]] = [[], []]
            for side in (0, 1):
                for _, _, data, offsets in text_chunks(batch.column(2 + side)):
                    flat, at = shingle_sets(split_words(data, offsets, lower=True, checked=True), width)
                    sets[side] += [flat[at[i] : at[i + 1]] for i in range(len(at) - 1)]
            common = [
                len(np.intersect1d(x, y, assume_unique=True))
                for x, y in zip(*sets, strict=True)
            ]
            total = [len(x) + len(y) - c for x, y, c in zip(*sets, common, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())],
                ["a", "b", "common", "total"],
            )

    return run


def _keyed(documents: DataFrame, *more: Column, by_text: Column | None = None) -> DataFrame:
    """Vertices: the id, or for rows without one (or where ``by_text``) the text."""
    text_key = F.xxhash64("text")
    beyond = F.lit(_NULL_FROM) + text_key.bitwiseAND(_NULL_FROM - 1)
    own = F.col("doc_id").cast("bigint")
    if by_text is not None:
        own = F.when(~by_text, own)
    return documents.select(
        F.coalesce(own, beyond).alias("id"), text_key.alias("text_key"), "text", *more
    )


def neighbours(classes: DataFrame) -> DataFrame:
    """Members of the forest's regions: ``id, text_key, tree, label, region``.

    Rows that share no region with another are left out.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select("id", "text_key", "labels", trees).select(
        "id",
        "text_key",
        F.col("tree").cast("tinyint").alias("tree"),
        F.expr(f"substring(labels, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("label"),
    )
    rows = rows.withColumn("region", F.xxhash64("tree", F.substring("label", 1, 4 * LEAST)))
    shared = (
        rows.groupBy(F.col("region").alias("_region"))
        .agg(F.count(F.lit(1)).alias("members"))
        .where("members > 1")
    )
    # A region of near copies may hold a large share of the rows.
    return join_by_key(rows, "region", shared, "_region", "inner", salt_from=["id"]).drop("_region")


def candidate_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs of neighbours, ``a < b``, with the summed length of common prefixes."""
    placed = assign_ids(members, ["tree", "label", "id"], start=0, into="place")
    block = F.floor(F.col("place") / BLOCK)
    late = F.col("place") % BLOCK >= BLOCK - NEIGHBOURS
    spread = placed.withColumn(
        "block", F.explode(F.when(late, F.array(block, block + 1)).otherwise(F.array(block)))
    )
    order = Window.partitionBy("block").orderBy("place")
    own = F.struct("id", "text_key", "region", "label")
    before = F.array(*[F.lag(own, k).over(order) for k in range(1, NEIGHBOURS + 1)])
    met = (
        spread.withColumn("before", before)
        .where(block == F.col("block"))
        .select("id", "text_key", "region", "label", F.explode("before").alias("o"))
        .where("o.region = region AND o.id <> id")
    )
    depth = sum(
        F.when(F.substring("label", 1, 4 * d) == F.substring("o.label", 1, 4 * d), 1).otherwise(0)
        for d in range(1, DEPTH + 1)
    )
    less = F.col("id") < F.col("o.id")
    mine, other = F.struct("id", "text_key"), F.struct("o.id", "o.text_key")
    return (
        met.select(
            F.when(less, mine).otherwise(other).alias("x"),
            F.when(less, other).otherwise(mine).alias("y"),
            depth.alias("depth"),
        )
        .groupBy("x", "y")
        .agg(F.sum("depth").alias("weight"))
        .select(
            F.col("x.id").alias("a"), F.col("x.text_key").alias("a_key"),
            F.col("y.id").alias("b"), F.col("y.text_key").alias("b_key"), "weight",
        )
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    left = texts.select(F.col("id").alias("a"), F.col("text_key").alias("a_key"), F.col("text").alias("a_text"))
    right = texts.select(F.col("id").alias("b"), F.col("text_key").alias("b_key"), F.col("text").alias("b_text"))
    both = pairs.join(left, ["a", "a_key"]).join(right, ["b", "b_key"])
    return (
        both.select("a", "b", "a_text", "b_text")
        .mapInArrow(_overlaps(width), "a bigint, b bigint, common bigint, total bigint")
        .where(F.col("common") * 100 >= F.col("total") * percent)
        .select("a", "b")
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    joined = pairs.join(one, "a", "left").join(two, "b", "left")
    return joined.where(
        F.coalesce("_ca", "a") != F.coalesce("_cb", "b")
    ).drop("_ca", "_cb")


def _pivot_pairs(crowded: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """Each crowded region's best linked member against those not connected with it."""
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(
        F.count(F.lit(1)).alias("degree")
    )
    known = labels.select(F.col("node").alias("id"), "component")
    rows = (
        crowded.join(degree, "id", "left").join(known, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .withColumn("degree", F.coalesce("degree", F.lit(0)))
    )
    pivot = rows.groupBy("region").agg(
        F.max(F.struct("degree", -F.col("id"), "id", "text_key", "component")).alias("p")
    ).select(F.col("region").alias("_region"), "p")
    return (
        join_by_key(rows, "region", pivot, "_region", "inner", salt_from=["id"])
        .where("component <> p.component")
        .select(
            F.least("id", "p.id").alias("a"),
            F.when(F.col("id") < F.col("p.id"), F.col("text_key")).otherwise(F.col("p.text_key")).alias("a_key"),
            F.greatest("id", "p.id").alias("b"),
            F.when(F.col("id") < F.col("p.id"), F.col("p.text_key")).otherwise(F.col("text_key")).alias("b_key"),
        )
        .distinct()
    )


def _shingle_rows(width: int):
    """One row for each distinct shingle of each text, with the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_chunks(batch.column(2)):
                flat, bounds = shingle_sets(split_words(data, offsets, lower=True, checked=True), width)
                sizes = np.diff(bounds)
                owner = pa.array(np.repeat(np.arange(row, end), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owner),
                        batch.column(1).take(owner),
                        pa.array(np.repeat(sizes, sizes)),
                        pa.array(signed(flat)),
                    ],
                    ["id", "text_key", "n", "shingle"],
                )

    return run


def prefix_pairs(texts: DataFrame, labels: DataFrame, width: int, percent: int) -> DataFrame:
    """All pairs of ``texts`` (id, text_key, text) that may be similar and are not connected.

    With the shingles of both sets in one order, rarest first, the first common
    one of two sets with an overlap of ``o`` has ``o - 1`` others behind it in
    each. The shorter set therefore shows it among its first ``n - o + 1`` for
    the least ``o`` that two sets of its size need, the longer one for the least
    that its own size needs. Shingles of one set only take places but no rows.
    """
    known = labels.select(F.col("node").alias("id"), "component")
    owned = texts.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = cut_lineage(
        texts.select("id", "text_key", "text").mapInArrow(
            _shingle_rows(width), "id bigint, text_key bigint, n bigint, shingle bigint"
        )
    )
    often = (
        rows.groupBy(F.col("shingle").alias("_shingle"))
        .agg(F.count(F.lit(1)).alias("often"))
        .where("often > 1")
    )
    text = Window.partitionBy("id", "text_key")
    shared = F.count(F.lit(1)).over(text)
    rank = F.row_number().over(text.orderBy("often", "shingle"))
    prefixes = (
        # A shingle of a template stands in all its copies.
        join_by_key(rows, "shingle", often, "_shingle", "inner", salt_from=["id"])
        .select("id", "text_key", "n", "shingle", (F.col("n") - shared + rank - 1).alias("place"))
        .where(F.col("place") * 100 <= F.col("n") * (100 - percent))
        .withColumn("short", F.col("place") * (100 + percent) <= F.col("n") * (100 - percent))
        .join(owned.select("id", "text_key", "component"), ["id", "text_key"])
    )
    prefixes = cut_lineage(prefixes)
    # Members of one component need no look: the largest one of each shingle does not meet itself.
    homes = (
        prefixes.groupBy("shingle", "component")
        .agg(F.count(F.lit(1)).alias("held"), F.max("short").alias("short"))
        .groupBy(F.col("shingle").alias("_shingle"))
        .agg(
            F.max(F.struct("held", "component"))["component"].alias("home"),
            F.count(F.lit(1)).alias("kinds"),
            F.max("short").alias("met"),
        )
        .where("kinds > 1 AND met")
        .select("_shingle", "home")
    )
    spread = cut_lineage(
        join_by_key(prefixes, "shingle", homes, "_shingle", "inner", salt_from=["id"])
        .withColumn("away", F.col("component") != F.col("home"))
        .drop("_shingle", "home")
    )
    names = ["id", "text_key", "n", "place", "component", "away"]
    x = spread.where("short").select("shingle", *[F.col(c).alias(f"x_{c}") for c in names])
    y = spread.select("shingle", *[F.col(c).alias(f"y_{c}") for c in names])
    room = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    fits = (
        (F.struct("x_n", "x_id", "x_text_key") < F.struct("y_n", "y_id", "y_text_key"))
        & (F.col("x_component") != F.col("y_component"))
        & ((F.col("x_n") + F.col("y_n")) * percent <= room * (100 + percent))
    )

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.withColumnRenamed("shingle", "_s").join(y, (F.col("_s") == F.col("shingle")) & fits)

    both = met(x.where("x_away"), y).unionByName(met(x.where("NOT x_away"), y.where("y_away")))
    less = F.col("x_id") < F.col("y_id")

    def ends(first: str, second: str, a: str, b: str) -> list[Column]:
        return [
            F.when(less, F.col(first + c)).otherwise(F.col(second + c)).alias(n)
            for c, n in (("id", a), ("text_key", b))
        ]

    return (
        both.select(*ends("x_", "y_", "a", "a_key"), *ends("y_", "x_", "b", "b_key"))
        .groupBy("a", "a_key", "b", "b_key")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """The best candidate of each document, as the larger and as the smaller of a pair.

    A maximum is formed before the shuffle, so a document with most of the
    candidates is one row per task.
    """
    rank = F.struct("weight", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"), "a", "a_key", "b", "b_key")
    best = [pairs.groupBy(end).agg(F.max(rank).alias("best")).select("best.*") for end in ("a", "b")]
    return best[0].union(best[1]).select("a", "a_key", "b", "b_key").distinct()


_PAIR = ["a", "a_key", "b", "b_key"]


def _linked(
    pairs: DataFrame,
    texts: DataFrame,
    links: DataFrame | None,
    width: int,
    percent: int,
    crowded: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links with those that ``pairs`` confirm, components, and the pairs that were tried.

    The best candidates come first; others, and pivots of the ``crowded`` regions,
    only where their ends are not connected by then.
    """
    first = cut_lineage(_best_pairs(pairs))
    found = _confirmed(first, texts, width, percent)
    links = cut_lineage(found if links is None else links.union(found))
    labels = components(links)
    asked, tried = _apart(pairs.join(first, _PAIR, "left_anti"), labels).select(*_PAIR), pairs.select(*_PAIR)
    if crowded is not None:
        pivots = _pivot_pairs(crowded, links, labels).select(*_PAIR)
        pivots = cut_lineage(pivots.join(tried, _PAIR, "left_anti"))
        asked, tried = asked.union(pivots), tried.union(pivots)
    links = cut_lineage(links.union(_confirmed(asked, texts, width, percent)))
    drop_state(first)
    return links, components(links), tried


def near_duplicates(
    documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, by_text: Column | None = None
) -> DataFrame:
    """``id, text_key, n_shingles, component`` for every row of ``documents``.

    Rows where the condition ``by_text`` holds are vertices by their text.
    """
    keyed = _keyed(documents, by_text=by_text)
    described = cut_lineage(
        keyed.mapInArrow(
            _describe(width),
            "id bigint, text_key bigint, n_shingles bigint, set_a bigint, set_b bigint, labels binary",
        )
    )
    full = described.where("n_shingles > 0")
    owners = full.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("id", "text_key", "labels")).alias("own")
    )
    owners = cut_lineage(owners)
    members = cut_lineage(neighbours(owners.select("own.*")))
    pairs = cut_lineage(candidate_pairs(members.drop("members")))
    crowded = members.where(F.col("members") > NEIGHBOURS + 1).select("region", "id", "text_key")
    involved = pairs.select(F.col("a").alias("id"), F.col("a_key").alias("text_key")).union(
        pairs.select("b", "b_key")
    ).union(crowded.select("id", "text_key")).distinct()
    texts = cut_lineage(keyed.join(involved, ["id", "text_key"]).dropDuplicates(["id", "text_key"]))

    links, labels, tried = _linked(pairs, texts, None, width, percent, crowded)

    finishing = texts.join(crowded.select("id", "text_key").distinct(), ["id", "text_key"])
    asked = cut_lineage(
        prefix_pairs(finishing, labels, width, percent).join(tried, _PAIR, "left_anti")
    )
    if not asked.isEmpty():
        links, labels, _ = _linked(asked, texts, links, width, percent)

    same_set = F.struct("set_a", "set_b", "n_shingles")
    classes = owners.select(same_set.alias("_set"), F.col("own.id").alias("owner"))
    # Copies of one text may hold a large share of the rows.
    rows = join_by_key(
        described.drop("labels").withColumn("set", same_set), "set", classes, "_set", "left", ["id"]
    )
    rows = cut_lineage(rows.select("id", "text_key", "n_shingles", F.coalesce("owner", "id").alias("owner")))
    # A doc_id whose rows have different texts ties their classes together.
    several = rows.where("n_shingles > 0").groupBy("id").agg(
        F.min("owner").alias("low"), F.max("owner").alias("high")
    ).where("low < high")
    tied = rows.join(several.select("id"), "id").select(F.col("id").alias("a"), F.col("owner").alias("b"))
    tied = cut_lineage(tied)
    if not tied.isEmpty():
        labels = components(links.union(tied))
    found = labels.select(F.col("node").alias("owner"), "component")
    return rows.join(found, "owner", "left").select(
        "id", "text_key", "n_shingles", F.coalesce("component", "owner").alias("component")
    )


def duplicate_report(documents: DataFrame) -> DataFrame:
    """One row per document: set size, component and whether it is the one to keep."""
    found = near_duplicates(documents)

    def named(name: str) -> Column:
        return F.when(F.col(name) < _NULL_FROM, F.col(name))

    return found.select(
        named("id").alias("doc_id"),
        "n_shingles",
        named("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def drop_duplicates(documents: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group, the smallest, with all its columns.

    No text is lost without a like one that stays: where an id stands with
    different texts, each of them is a vertex of its own, larger than those of
    all other ids; equal texts of such ids, and of rows without one, are one
    vertex, of which the smallest id stays. Of rows that repeat an id and a text,
    any one stays.
    """
    text_key = F.xxhash64("text")
    several = (
        documents.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_several"))
        .agg(F.min(text_key).alias("low"), F.max(text_key).alias("high"))
        .where("low < high")
        .select("_several")
    )
    several = cut_lineage(several)
    by_text = None
    if not several.isEmpty():
        names = documents.columns
        same = F.col("doc_id") == F.col("_several")
        documents = documents.join(several, same, "left").select(
            *names, F.col("_several").isNotNull().alias(_BY_TEXT)
        )
        by_text = F.col(_BY_TEXT)
    kept = (
        near_duplicates(documents, width, percent, by_text)
        .where("id = component")
        .select("id", "text_key")
        .distinct()
    )
    rows = F.struct(*[c for c in documents.columns if c != _BY_TEXT]).alias("row")
    keyed = _keyed(documents, rows, by_text=by_text).drop("text")
    smallest = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"))
    return (
        # Rows that repeat one text under one id stand together already.
        keyed.join(kept, ["id", "text_key"])
        .groupBy("id", "text_key")
        .agg(F.min_by("row", smallest).alias("row"))
        .select("row.*")
    )
