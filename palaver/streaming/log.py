"""A run log: one entry a batch, whatever is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(rows: DataFrame, folder: str, batch: int) -> None:
    """Writes the entries of a batch in its own place, so the same batch again takes the place of its first attempt."""
    rows.write.mode("overwrite").json(f"{folder}/batch={batch}")


def logged(stream: DataFrame, folder: str, aggregates: list, then=None):
    """A writer of the stream that logs `aggregates` of every batch and then hands its rows to `then(rows, batch)`."""

    def handle(rows: DataFrame, batch: int) -> None:
        if then:
            then(rows, batch)
        append(rows.agg(*aggregates), folder, batch)

    return stream.writeStream.foreachBatch(handle)


def entries(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All entries with their `batch`."""
    return spark.read.schema(f"{schema}, batch bigint").json(folder).select("batch", *(c for c in spark.createDataFrame([], schema).columns)).orderBy("batch")


def counts() -> list:
    return [F.count(F.lit(1)).alias("n")]
