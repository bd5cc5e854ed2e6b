"""Full names from a table of parent pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.sources.lineage import cut_lineage


def ancestry(
    nodes: DataFrame, keys: DataFrame, key: str = "id", parent: str = "id_parent"
) -> DataFrame:
    """The nodes of the one-column ``keys`` and all their ancestors.

    Each round looks up the parents met last, so it takes as many rounds as the
    deepest key has levels, and only ancestors are written.
    """
    wanted = keys.toDF("_wanted").distinct()
    found = None
    while True:
        step = cut_lineage(nodes.join(wanted, F.col(key) == F.col("_wanted"), "left_semi"))
        if step.isEmpty():
            return step if found is None else found
        found = step if found is None else found.unionByName(step)
        known = found.select(F.col(key).alias("_known"))
        wanted = (
            step.select(F.col(parent).alias("_wanted"))
            .where("_wanted IS NOT NULL")
            .distinct()
            .join(known, F.col("_wanted") == F.col("_known"), "left_anti")
        )


def full_names(
    nodes: DataFrame,
    key: str = "id",
    parent: str = "id_parent",
    name: str = "name",
    keys: DataFrame | None = None,
    one_job: bool = False,
) -> DataFrame:
    """``(id, fullname)`` for every node of a forest, any depth.

    ``one_job`` is for shallow forests: one lazy recursive query that goes down
    level by level, see ``recursive_names``. Otherwise rounds are run here, few
    for any depth.

    With ``keys``, a table of one column, only for those nodes; then nothing
    but they and their ancestors is worked on.

    A root's full name is empty; below it every level adds a blank and its
    name. Nodes that no root reaches (a missing parent, a cycle) get NULL.

    Every node keeps the part of its path found so far and the anchor, the
    ancestor where that part ends. In each round an open node takes over the
    part of its anchor, so the known length doubles: a chain of depth d needs
    about log2(d) rounds, each a join on the anchor. Only open nodes are
    written again. A round that closes no node has met nothing but cycles.
    Duplicate rows count once.
    """
    if one_job:
        names = recursive_names(nodes, key, parent, name)
        if keys is None:
            return names
        return names.join(keys.toDF("_key").distinct(), F.col("id") == F.col("_key"), "left_semi")
    if keys is not None:
        names = full_names(ancestry(nodes, keys, key, parent), key, parent, name)
        return names.join(keys.toDF("_key").distinct(), F.col("id") == F.col("_key"), "left_semi")
    start = (
        nodes.select(
            F.col(key).alias("id"), F.col(parent).alias("anchor"), F.col(name).alias("name")
        )
        .distinct()
        .select(
            "id",
            "anchor",
            F.when(F.col("anchor").isNull(), F.lit(""))
            .otherwise(F.concat(F.lit(" "), "name"))
            .alias("path"),
        )
    )
    # The roots go into the first copy, so the nodes are not read again.
    step = cut_lineage(_closed(start).unionByName(_extend(_open(start), start)))
    closed, still = _closed(step), _open(step)
    left = still.count()
    while left:
        step = cut_lineage(_extend(still, closed.unionByName(still)))
        before, left = left, _open(step).count()
        if left == before:
            break
        closed, still = closed.unionByName(_closed(step)), _open(step)
    return closed.select("id", F.col("path").alias("fullname")).unionByName(
        still.select("id", F.lit(None).cast("string").alias("fullname"))
    )


#: Levels that one recursive query goes down; a deeper forest fails there.
MOST_LEVELS = 100


def recursive_names(
    nodes: DataFrame, key: str = "id", parent: str = "id_parent", name: str = "name"
) -> DataFrame:
    """``full_names`` as one recursive query over the roots and their children.

    Lazy: nothing runs before it is read, so it can stand behind a view. Nodes
    that no root reaches are never met, so cycles end nothing and get NULL. Each
    level is a join with all nodes, hence for shallow forests; one of more than
    ``MOST_LEVELS`` levels fails and needs the rounds of ``full_names``.
    """
    spark = nodes.sparkSession
    # The engine stops a recursion after a number of rows unless told otherwise.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    every = nodes.select(
        F.col(key).alias("id"), F.col(parent).alias("parent"), F.col(name).alias("name")
    ).distinct()
    return spark.sql(
        f"""WITH RECURSIVE paths(id, fullname) MAX RECURSION LEVEL {MOST_LEVELS} AS (
            SELECT id, '' FROM {{every}} WHERE parent IS NULL
            UNION ALL
            SELECT n.id, p.fullname || ' ' || n.name FROM paths p JOIN {{every}} n ON n.parent = p.id)
        SELECT n.id, p.fullname FROM {{every}} n LEFT JOIN paths p ON p.id = n.id""",
        every=every,
    )


def _open(state: DataFrame) -> DataFrame:
    return state.where(F.col("anchor").isNotNull())


def _closed(state: DataFrame) -> DataFrame:
    return state.where(F.col("anchor").isNull())


def _extend(still: DataFrame, known: DataFrame) -> DataFrame:
    """Extend each open path by the path of its anchor.

    Where the anchor does not exist, or is itself without a path, the node
    closes with a NULL path.
    """
    anchors = known.select(
        F.col("id").alias("anchor"),
        F.col("anchor").alias("next_anchor"),
        F.col("path").alias("head"),
    )
    return still.join(anchors, "anchor", "left").select(
        "id",
        F.col("next_anchor").alias("anchor"),
        F.concat("head", "path").alias("path"),
    )
