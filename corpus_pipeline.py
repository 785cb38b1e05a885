"""A corpus pipeline over `documents`: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, folder of the tables) and returns a frame; all but the last return the
columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import decontaminate, packing, secrets, setjoin, toxicity
from palaver.llm.common import delete, new_folder
from palaver.llm.queries import table


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose probability of any toxicity is below one half."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that links by shared word 4-grams; the smallest id stays."""
    return setjoin.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark."""
    return decontaminate.remove(docs, table(spark, folder, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds and `n_chars` to match."""
    return secrets.redact(docs).withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 1024 ids and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("setjoin", drop_near_copies), ("decontaminate", drop_contaminated), ("secrets", redact_secrets), ("packing", pack_sequences)]

#: Trained scores and token ids can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The last stage's rows over `documents`; each stage's rows go when the next one has written its own."""
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(f"{path}/rows")
        docs = spark.read.parquet(f"{path}/rows")
        if before:
            delete(spark, before)
        before = path
    return docs
