"""Cut the lineage of a DataFrame through a table in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder the cluster names; a local session without one gets its own."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="verdure-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy outlives executors, keeps column pruning and filter pushdown, and
    has a known size, so later joins are planned on facts. What this function
    returned is such a copy and is given back as it is.
    """
    if hasattr(df, "written_state"):
        return df
    path = f"{checkpoint_folder(df.sparkSession)}/verdure-{uuid.uuid4().hex}"
    df.write.parquet(path)
    state = df.sparkSession.read.schema(df.schema).parquet(path)
    state.written_state = path
    return state


def drop_state(state: DataFrame) -> None:
    """Delete the table behind a result of ``cut_lineage``; any other DataFrame stays as it is.

    For loops whose next state is written: nothing may read this one any more,
    not even to make up for a lost executor, so only drop what went into a
    table that is written in full.
    """
    if not hasattr(state, "written_state"):
        return
    path = state.written_state
    spark = state.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
