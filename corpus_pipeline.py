"""A corpus for training: filters, near-duplicate removal, masking and packing, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all of ``docs`` and returns
a DataFrame that is written and read again as the next one's ``docs``. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdure.llm import decontamination, near_duplicates, packing, personal_data, toxicity
from verdure.sources.lineage import checkpoint_folder

TOKENIZER = "word_bpe_49k.json"


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.

    Each row is judged alone, so rows that repeat go or stay together; NULL and
    empty texts have the score of no words and stay unless the labels say that
    most documents are toxic. Without labels of both kinds the score of all is
    the share of toxic ones, 0 without any. An empty table stays empty; other
    columns are kept, whatever their names.
    """
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies stays.

    NULL, empty and blank texts have no shingles and are no copies of others, but
    rows that repeat an id and a text become one. Where an id stands with
    different texts, each of them keeps a representative; rows without an id are
    one document per text, larger than all with an id. Further columns are those
    of the row that stays.
    """
    return near_duplicates.drop_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    Texts without words, NULL among them, are never hit; each row is judged by
    its own text, so repeated rows go or stay together; items without words and
    an empty benchmark hit nothing.
    """
    return decontamination.drop_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


def personal_data_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that disclose it are masked; every document stays.

    A NULL text stays NULL, an empty one empty; rows that repeat are masked
    alike, and copies of a text are one piece of evidence. ``n_chars`` follows the
    new text, other columns stay as they are.
    """
    return personal_data.sanitise(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences.

    NULL and empty texts are the separator alone; repeated rows are documents
    like others and each has its pieces; an empty table gives no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicate_removal),
    ("decontamination", benchmark_decontamination),
    ("personal_data", personal_data_masking),
    ("packing", sequence_packing),
]

#: Training a tagger and tokenising are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/verdure-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
