"""Five stages that turn documents into packed training sequences.

Each stage takes the documents that the one before has kept and gives those that it keeps;
the last gives the pieces of the sequences. Stages are written out and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm import decontaminate, packing, pii, simhash, toxicity
from runnel.llm.queries import TOKENIZER, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the class models do not call toxic."""
    prepare(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies.

    Near copies have fingerprints over three-word shingles that differ in two bits or fewer;
    a group is what such links connect. Of rows that share an id the one with the smallest
    fingerprint stays. Null, empty and blank texts are copies of each other. A row without an
    id stays only where no document with an id is in its group. Ids do not have to be
    distinct, repeated rows count once, an empty table gives no rows.
    """
    prepare(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without a passage of the benchmark.

    Null and empty texts have no words and stay, as do all where the benchmark is empty.
    """
    prepare(spark)
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its personal data masked by their kind.

    ``n_chars``, where it is there, follows the masked text.
    """
    prepare(spark)
    found = pii.masked(docs)
    columns = [
        F.col("clean").alias(c) if c == "text" else
        F.length("clean").cast(kind).alias(c) if c == "n_chars" else
        F.col("row")[c].alias(c)
        for c, kind in docs.dtypes
    ]
    return found.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all documents that are left.

    A null text counts as empty, which is its end mark alone; texts over 2048 tokens are cut.
    """
    prepare(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL expresses neither the class models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    prepare(spark)
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{base}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
