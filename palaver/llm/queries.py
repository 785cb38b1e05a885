"""The queries of this subpackage: name to function of (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import new_folder
from palaver.llm.oracles import ORACLE  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # texts go to Python workers in batches of so many rows, which bounds what a worker holds
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import decontaminate

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, table(spark, folder, "benchmark")))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by markup, address and host, and documents by declared language and source."""
    from palaver.llm import langid

    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = langid.fit(docs)
    own = langid.evidence(langid.of_documents(docs), model, text_col="text", markup=False).select("doc_id", F.lit(None).cast("bigint").alias("page_id"), "host", "suffix", "declared", "like")
    web = langid.evidence(langid.of_pages(pages), model, text_col="text", markup=True).select(F.lit(None).cast("bigint").alias("doc_id"), "page_id", "host", "suffix", "declared", "like")
    return langid.fuse(own.union(web), model.languages).select("doc_id", "page_id", "host", "declared", "text_language", "language", "confidence")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import toxicity

    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "toxicity.severity", "toxicity.grade", "toxicity.p_toxic", (F.col("toxicity.p_toxic") >= 0.5).alias("toxic"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import fingerprint

    return fingerprint.digest(table(spark, folder, "documents"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import secrets

    return secrets.digest(table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import quality

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).select("doc_id", "quality.posterior", "quality.score", "quality.keep")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import warc

    path = f"{new_folder(spark, 'warc')}/archive"
    warc.write(table(spark, folder, "pages"), path)
    # pushed down to the headers; the payload is read of responses alone
    back = warc.read(spark, path).where(F.col("record_type").isin("response", "revisit"))
    return back.select("page_id", "payload_bytes", F.coalesce("payload_sha256", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import sharding

    return sharding.assign(table(spark, folder, "documents"))


def op9_setjoin(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import setjoin

    return setjoin.link(table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from palaver.llm import packing

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label_col=label)


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    from palaver.llm import phrases

    return phrases.collocations(table(spark, folder, "documents"))


def op13_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from palaver.llm import idfiles

    path = f"{new_folder(spark, 'ids')}/parts"
    idfiles.write_texts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return idfiles.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    f.__name__: f for f in (
        op1_decontaminate, op2_language, op3_toxicity, op4_fingerprints, op5_secrets, op6_quality, op7_warc, op8_sharding, op9_setjoin,
        op10_packing, op11_negatives, op12_phrases, op13_token_ids,
    )
}
