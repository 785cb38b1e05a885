"""Streams of messages: keyed dedup in a file stream, and rate limits."""

from __future__ import annotations

import logging
import random
import tempfile
import uuid
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(stream: DataFrame, keys: list[str], time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; with `time`, state older than the delay is forgotten."""
    if time:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All there is in the stream's source, written as Parquet and read back."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def bounded_seen(df: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Rows whose key isn't among the `most` keys last added in their group (first in, first out)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        seen: dict = {}
        keep = []
        for k in rows.sort_values("seq")[key]:
            keep.append(k not in seen)
            if k not in seen:
                seen[k] = True
                if len(seen) > most:
                    del seen[next(iter(seen))]
        return rows.sort_values("seq")[keep]

    return df.groupBy(group).applyInPandas(run, df.schema)


def rate_limited(df: DataFrame, group: str, per_hour: int = 40, spacing: float = 12.0) -> DataFrame:
    """`sent`: at most `per_hour` sends in 3600 s and `spacing` seconds between two; only sends count."""
    schema = f"{group} string, seq bigint, at double, sent boolean"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, sends, out = rows.sort_values(["at", "seq"]), [], []
        for at in rows["at"]:
            sends = [x for x in sends if at - x < 3600]
            ok = len(sends) < per_hour and (not sends or at - sends[-1] >= spacing)
            out.append(ok)
            if ok:
                sends.append(at)
        return rows.assign(sent=out)[[group, "seq", "at", "sent"]]

    return df.select(F.col(group).cast("string").alias(group), "seq", "at").groupBy(group).applyInPandas(run, schema)


def falls_back(group: str, seq: int, sure: float, total: int, held: int, threshold: float, target: float) -> bool:
    """Whether a reply falls back, `total` of the `held` decisions before it having done so.

    At the target itself, and before any decision, a draw seeded by group and `seq` decides.
    """
    share = total / held if held else target
    allowed = target > 0 and (share < target or share == target and random.Random(f"{group}/{seq}").random() < target)
    return bool(sure < threshold and allowed)


def fallback_rate(df: DataFrame, group: str, *, threshold: float = 0.5, target: float = 0.2, window: int = 200) -> DataFrame:
    """`fallback`: replies of a confidence below the threshold, as long as the share in the window is below the target.

    At the target itself, and before any decision, a draw seeded by group and `seq` decides.
    """
    window = max(20, window)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, past, out = rows.sort_values("seq"), deque(maxlen=window), []
        for name, seq, sure in zip(rows[group], rows["seq"], rows["confidence"], strict=True):
            out.append(falls_back(name, seq, sure, sum(past), len(past), threshold, target))
            past.append(int(out[-1]))
        return rows.assign(fallback=out)[[group, "seq", "fallback"]]

    return df.select(F.col(group).cast("string").alias(group), F.col("seq").cast("bigint").alias("seq"), F.col("confidence").cast("double").alias("confidence")).groupBy(group).applyInPandas(run, f"{group} string, seq bigint, fallback boolean")


def folder(spark, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, deleted when the driver ends; a local one only where driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    path = f"{(named or tempfile.mkdtemp(prefix='shared-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def poll(stream: DataFrame, handle, checkpoint: str, every: float = 5.0, stop=lambda: False, tries: int = 3) -> int:
    """Runs `handle` on each batch of the stream until `stop()`; a batch that fails is logged and tried again with the query.

    The number of batches handled.  `every` is in seconds, 0.3 at least.
    """
    done, failed = [], 0
    while True:
        query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=f"{max(300, int(every * 1000))} milliseconds")
        query = query.foreachBatch(lambda rows, number: (handle(rows, number), done.append(number))[0]).start()
        while query.isActive and not stop():
            query.awaitTermination(0.2)
        if query.exception() is None or failed == tries:
            query.stop()
            return len(done)
        failed += 1
        logging.getLogger(__name__).warning("a batch failed: %s", query.exception())
