"""Approximate nearest neighbours by inner product on robust-pruned graphs, shard by shard.

Every usable vector belongs to a shard of vectors of a like size (``BAND`` binary
digits of the largest component), by a hash, so that shards are equally large
whatever the vectors are; rows that repeat an id and a vector are one row with a
count. Shards grow with the table up to ``SHARD_BYTES``, so their number, and with
it the work of a query, grows only once memory is the limit. In a shard equal
vectors are one node. Vectors are scaled to the longest one of the shard and
lifted by one coordinate to its length; largest inner product is then smallest
distance. Nodes enter the graph in batches: a greedy search from the entry point
proposes neighbours, robust pruning keeps the near ones that are not behind one
another (distances relaxed by ``ALPHA``), and all reverse edges are pruned alike, a
part at a time. Nodes that the entry point does not reach are linked in the end
from the nearest node that it does reach.

The index is a table with one row per id and vector. Queries go to every shard
in blocks; a beam search finds their nodes, the nodes' rows are scored exactly in
double precision on the vectors as they are, and the best of all shards are
ranked by Spark.

Defined results: vectors that are NULL, empty, zero or have a NULL or
non-finite component take no part; vectors of different lengths never meet; a
query never finds rows with its own id; rows that repeat a query give one
answer; a NULL id is no query, and in ties it comes last.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdure.sources.lineage import cut_lineage

#: A shard holds so many rows, or its part of the table in so many shards if that is more.
SHARD_ROWS, SHARDS = 16_384, 64
#: Bytes of vectors and edges that one shard holds at most.
SHARD_BYTES = 1 << 28
QUERY_BLOCK = 131_072
BAND = 16
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
EXPAND = 4
BATCH = 1024
K = 20
_LAST = (1 << 63) - 1


def usable(embeddings: DataFrame) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(_LAST)).alias("id"), vector.alias("vector")
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    return rows.where("vector IS NOT NULL AND size(vector) > 0").where(finite).where(
        F.exists("vector", lambda x: x != 0)
    )


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the length of the longest one; numbers of any size keep their digits."""
    vectors = vectors / np.abs(vectors).max()
    return vectors / np.sqrt((vectors**2).sum(axis=1).max())


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors of equal length in one more dimension."""
    vectors = scaled(vectors)
    square = (vectors**2).sum(axis=1)
    extra = np.sqrt(np.maximum(1 - square, 0))
    return np.column_stack([vectors, extra]).astype(np.float32)


def asked_points(queries: np.ndarray) -> np.ndarray:
    """Queries of length 1, which changes no order, with the coordinate of the lift."""
    unit = queries / np.abs(queries).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit**2).sum(axis=1, keepdims=True))
    return np.column_stack([unit, np.zeros(len(unit))]).astype(np.float32)


def beam_search(
    points: np.ndarray, edges: np.ndarray, entry: int, asked: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nodes found for each row of ``asked`` and their products, best first (-1: none)."""
    n, rows = len(asked), np.arange(len(asked))[:, None]
    ids = np.full((n, beam), -1, dtype=np.int64)
    near = np.full((n, beam), -np.inf, dtype=np.float32)
    open_ = np.zeros((n, beam), dtype=bool)
    ids[:, 0], open_[:, 0] = entry, True
    near[:, 0] = asked @ points[entry]
    while open_.any():
        # The best places not yet expanded of each row.
        key = np.where(open_, near, -np.inf)
        take = np.argpartition(-key, min(EXPAND, beam - 1), axis=1)[:, :EXPAND]
        valid = np.take_along_axis(open_, take, axis=1)
        open_[rows, take] = False
        chosen = np.where(valid, np.take_along_axis(ids, take, axis=1), -1)
        found = np.where(chosen[:, :, None] >= 0, edges[chosen], -1).reshape(n, -1)
        live = found >= 0
        value = np.einsum("nkd,nd->nk", points[found], asked, optimize=True)
        value = np.where(live, value, -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids, found], axis=1)
        all_near = np.concatenate([near, value], axis=1)
        all_open = np.concatenate([open_, live], axis=1)
        # A node found again comes after its first place in a stable order.
        order = np.argsort(all_ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(all_ids, order, axis=1)
        again = np.zeros_like(all_open)
        again[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
        repeat = np.zeros_like(all_open)
        np.put_along_axis(repeat, order, again, axis=1)
        all_near[repeat] = -np.inf
        all_open[repeat] = False
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids = np.take_along_axis(all_ids, best, axis=1)
        near = np.take_along_axis(all_near, best, axis=1)
        open_ = np.take_along_axis(all_open, best, axis=1) & np.isfinite(near)
        ids[~np.isfinite(near)] = -1
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)


def robust_prune(
    points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` neighbours of each node of ``own`` out of its candidates (-1: none)."""
    out = np.full((len(own), degree), -1, dtype=np.int64)
    for at in range(0, len(own), 256):
        mine, held = own[at : at + 256], candidates[at : at + 256]
        there = points[held]
        away = ((there - points[mine][:, None, :]) ** 2).sum(axis=2)
        alive = (held >= 0) & (held != mine[:, None])
        order = np.argsort(np.where(alive, away, np.inf), axis=1)
        held = np.take_along_axis(held, order, axis=1)
        away = np.take_along_axis(away, order, axis=1)
        alive = np.take_along_axis(alive, order, axis=1)
        # The same candidate twice.
        there = points[held]
        square = (there**2).sum(axis=2)
        between = square[:, :, None] + square[:, None, :] - 2 * there @ there.transpose(0, 2, 1)
        count = np.zeros(len(mine), dtype=np.int64)
        for k in range(held.shape[1]):
            keep = np.flatnonzero(alive[:, k] & (count < degree))
            if not len(keep):
                continue
            out[at + keep, count[keep]] = held[keep, k]
            count[keep] += 1
            behind = alpha * alpha * between[keep, k] <= away[keep]
            alive[keep] &= ~behind
            alive[keep, k] = False
    return out


def build_graph(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """Edges (-1: none) of the graph over different vectors, and its entry point."""
    points = lifted(vectors)
    n = len(points)
    edges = np.full((n, DEGREE), -1, dtype=np.int64)
    order = np.random.default_rng(11).permutation(n)
    entry = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.append(entry, order[order != entry])
    done = 1
    while done < n:
        batch = order[done : done + min(max(done, 16), BATCH)]
        found, _ = beam_search(points, edges, entry, points[batch], BUILD_BEAM)
        edges[batch] = robust_prune(points, batch, found, DEGREE, ALPHA)
        source = np.repeat(batch, DEGREE)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        _add_reverse(points, edges, source, target)
        done += len(batch)
    return _all_reached(points, edges, entry), entry


def _add_reverse(points: np.ndarray, edges: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
    """Adds edges from targets back to sources; a node that has too many is pruned, some at a time."""
    away = ((points[source] - points[target]) ** 2).sum(axis=1)
    order = np.lexsort((away, target))
    source, target = source[order], target[order]
    while len(target):
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        most = min(int(count.max()), 2 * DEGREE)
        place = np.arange(most)[None, :]
        new = np.where(place < count[:, None], source[np.minimum(first[:, None] + place, len(source) - 1)], -1)
        both = np.concatenate([edges[nodes], new], axis=1)
        full = (both >= 0).sum(axis=1) > DEGREE
        if full.any():
            edges[nodes[full]] = robust_prune(points, nodes[full], both[full], DEGREE, ALPHA)
        rest = both[~full]
        edges[nodes[~full]] = np.take_along_axis(rest, np.argsort(rest < 0, axis=1, kind="stable"), axis=1)[:, :DEGREE]
        later = np.arange(len(target)) - np.repeat(first, count) >= most
        source, target = source[later], target[later]


def _reached(edges: np.ndarray, start: np.ndarray, seen: np.ndarray) -> None:
    """Marks in ``seen`` all that can be reached from ``start``."""
    seen[start] = True
    while len(start):
        start = np.unique(edges[start])
        start = start[start >= 0]
        start = start[~seen[start]]
        seen[start] = True


def _all_reached(points: np.ndarray, edges: np.ndarray, entry: int) -> np.ndarray:
    """``edges`` with links to what the entry does not reach, in columns of their own if need be."""
    seen = np.zeros(len(points), dtype=bool)
    _reached(edges, np.array([entry]), seen)
    for node in np.flatnonzero(~seen).tolist():
        if seen[node]:
            continue
        near, _ = beam_search(points, edges, entry, points[[node]], BUILD_BEAM)
        near = near[0][near[0] >= 0]
        free = (edges[near] < 0).any(axis=1)
        if not free.any():
            edges = np.column_stack([edges, np.full(len(edges), -1)])
            free[:] = True
        # The nearest one with room; edges are filled from the left.
        place = int(near[np.flatnonzero(free)[0]])
        edges[place, int(np.argmax(edges[place] < 0))] = node
        _reached(edges, np.array([node]), seen)
    return edges


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _index_shard(table: pa.Table) -> pa.Table:
    vectors = _matrix(table.column("vector"))
    different, node = np.unique(vectors, axis=0, return_inverse=True)
    node = node.ravel()
    edges, entry = build_graph(different)
    width = edges.shape[1]
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(0, (len(node) + 1) * width, width, dtype=np.int32)),
        pa.array(edges[node].astype(np.int32).ravel()),
    )
    return pa.table(
        {
            **{c: table.column(c) for c in ("dims", "band", "shard", "id", "copies", "vector")},
            "node": pa.array(node.astype(np.int32)),
            "entry": pa.array(np.full(len(node), entry, dtype=np.int32)),
            "edges": lists,
        }
    )


def build_index(embeddings: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per usable id and vector: its shard, its node there and the node's edges."""
    largest = F.aggregate("vector", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x)))
    rows = (
        usable(embeddings)
        .groupBy("id", "vector")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumns({"dims": F.size("vector"), "band": F.floor(F.log2(largest) / BAND).cast("int")})
    )
    rows = cut_lineage(rows)
    held = F.least(
        F.greatest(F.lit(shard_rows), F.count(F.lit(1)) / SHARDS),
        F.lit(SHARD_BYTES) / (8 * F.col("dims") + 8 * DEGREE),
    )
    shards = F.ceil(F.count(F.lit(1)) / F.greatest(held, F.lit(1))).cast("int")
    # One row per length of vectors and band.
    counts = cut_lineage(rows.groupBy("dims", "band").agg(shards.alias("shards")))
    total = counts.agg(F.sum("shards").alias("n")).first()["n"] or 1
    placed = (
        rows.join(F.broadcast(counts), ["dims", "band"])
        .withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.col("shards")).cast("int"))
        .drop("shards")
    )
    schema = (
        "dims int, band int, shard int, id bigint, copies bigint, vector array<double>, node int, entry int,"
        " edges array<int>"
    )
    key = ("dims", "band", "shard")
    # As many partitions as shards, which are not merged: a shard is built by one task.
    return cut_lineage(placed.repartition(total, *key).groupBy(*key).applyInArrow(_index_shard, schema))


def _search_shard(beam: int, k: int):
    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        empty = {"query_id": [], "query_key": [], "id": [], "score": []}
        kinds = pa.schema(
            [("query_id", pa.int64()), ("query_key", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]
        )
        if not index.num_rows or not asked.num_rows:
            return pa.table(empty, kinds)
        vectors, queries = _matrix(index.column("vector")), _matrix(asked.column("vector"))
        ids = index.column("id").to_numpy()
        node = index.column("node").to_numpy()
        copies = np.minimum(index.column("copies").to_numpy(), k)
        # Rows by node, smallest ids first; one row of each node stands for it.
        order = np.lexsort((ids, node))
        begin = np.flatnonzero(np.append(True, node[order][1:] != node[order][:-1]))
        size = np.diff(np.append(begin, len(order)))
        stands = order[begin]
        edges = _matrix(index.column("edges"))[stands].astype(np.int64)
        points = lifted(vectors[stands])
        entry = int(index.column("entry")[0].as_py())
        query_id, query_key = asked.column("id").to_numpy(), asked.column("query_key").to_numpy()
        parts = []
        for at in range(0, len(queries), BATCH):
            block = queries[at : at + BATCH]
            found, _ = beam_search(points, edges, entry, asked_points(block), max(beam, k + 1))
            for i in range(len(block)):
                nodes = found[i][found[i] >= 0][: k + 1 + EXPAND]
                # Equal vectors: the k + 1 smallest ids are enough, one may be the query's own.
                rows = [order[begin[x] : begin[x] + min(size[x], k + 1)] for x in nodes]
                rows = np.concatenate([np.zeros(0, dtype=np.int64), *rows])
                rows = rows[ids[rows] != query_id[at + i]]
                rows = np.repeat(rows, copies[rows])
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (vectors[rows] * block[i]).sum(axis=1)
                best = np.lexsort((ids[rows], -score))[:k]
                parts.append((at + i, ids[rows[best]], score[best]))
        owner = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int64)
        return pa.table(
            {
                "query_id": query_id[owner],
                "query_key": query_key[owner],
                "id": np.concatenate([p[1] for p in parts]),
                "score": np.concatenate([p[2] for p in parts]),
            },
            kinds,
        )

    return run


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM) -> DataFrame:
    """The ``k`` nearest of each query (``vec_id, embedding``) that the graphs find."""
    asked = usable(queries).withColumns(
        {"dims": F.size("vector"), "query_key": F.xxhash64("vector")}
    ).dropDuplicates(["id", "query_key"])
    key = ("dims", "band", "shard")
    shards = index.select(*[F.col(c).alias(f"q_{c}") for c in key]).distinct()
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    everywhere = asked.withColumn(
        "q_block", F.pmod(F.col("query_key"), F.lit(blocks)).cast("int")
    ).join(shards, F.col("dims") == F.col("q_dims")).drop("dims")
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    there = copies.groupBy(*key, "block")
    met = there.cogroup(everywhere.groupBy(*[f"q_{c}" for c in key], "q_block")).applyInArrow(
        _search_shard(beam, k), "query_id bigint, query_key bigint, id bigint, score double"
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            "query_id",
            "rank",
            F.when(F.col("id") < _LAST, F.col("id")).alias("vec_id"),
            "score",
        )
    )


def neighbours_of_every_twentieth(embeddings: DataFrame) -> DataFrame:
    return search(build_index(embeddings), embeddings.where("vec_id % 20 = 0"))
