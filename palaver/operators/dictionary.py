"""A vocabulary of speakers learned from the messages: dense ids in order of token, of any number of speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.operators.ordered import laid
from palaver.operators.tokens import BASE, speaker_tokens

#: Entries up to which a vocabulary is broadcast: some hundred megabytes at most.
BROADCAST = 1_000_000
STATE = "speaker string, token string, id bigint"


def learn(messages: DataFrame, column: str = "speaker") -> DataFrame:
    """`speaker`, `token`, `id` of all speakers that occur: the base tokens have the first ids, the others follow in order of token.

    A speaker's id depends on the set of speakers alone.  A null speaker has no entry and looks up as unknown; one whose token is a
    base token has that one's id.
    """
    named = speaker_tokens(messages.select(F.col(column).alias("speaker")).where("speaker is not null"))
    base = messages.sparkSession.createDataFrame(list(zip(BASE, range(len(BASE)), strict=True)), "token string, id bigint")
    fresh = laid(named.join(F.broadcast(base), "token", "left_anti").select("token").distinct(), ["token"])
    # the lower 33 bits count within the range
    own = fresh.withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33))
    past = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = own.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_before"))
    ids = own.join(F.broadcast(ranges), "_part").select("token", (F.col("_before") + F.col("_at") + len(BASE)).alias("id")).union(base)
    return named.join(ids, "token").select("speaker", "token", "id")


def look_up(rows: DataFrame, vocabulary: DataFrame, column: str = "speaker", into: str = "token_id", most: int = BROADCAST) -> DataFrame:
    """The rows with their speaker's id, that of the unknown speaker where it has none; broadcast only up to `most` entries."""
    table = vocabulary.select(F.col("speaker").alias("_speaker"), F.col("id").alias("_id"))
    table = F.broadcast(table) if vocabulary.limit(most + 1).count() <= most else table
    found = rows.drop(into).join(table, F.col(column) == F.col("_speaker"), "left")
    return found.withColumn(into, F.coalesce("_id", F.lit(BASE.index("<|spk:UNKNOWN|>")).cast("bigint"))).drop("_speaker", "_id")


def save(vocabulary: DataFrame, path: str) -> None:
    """The state as JSON lines in order of id."""
    vocabulary.orderBy("id", "speaker").write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).option("mode", "FAILFAST").json(path)
