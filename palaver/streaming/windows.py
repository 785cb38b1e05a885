"""Event-time windows over streams: tumbling, sliding and by session, with watermarks; late rows are counted apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def windowed(stream: DataFrame, time: str, keys: list[str], aggregates: list[Column], *, size: str | None = None, slide: str | None = None, gap: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """`keys`, `started`, `ended` and the aggregates of each window.

    Windows are of `size`, beginning every `slide` (every `size` without it), or end `gap` after a key's last row.  A row is late
    when all its windows ended `delay` or more before the latest time that was known when the batch before began; such rows add to no window.  A null time
    belongs to no window.
    """
    if bool(size) == bool(gap):
        raise ValueError("either a size or a gap is needed")
    window = F.session_window(time, gap) if gap else F.window(time, size, slide or size)
    # a watermark needs a time with a zone, here the session's; the windows' edges have the column's own type again
    own = stream.schema[time].dataType.simpleString()
    rows = stream.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).groupBy(*keys, window.alias("_window")).agg(*aggregates)
    return rows.select(*keys, F.col("_window.start").cast(own).alias("started"), F.col("_window.end").cast(own).alias("ended"), *(c for c in rows.columns if c not in (*keys, "_window")))


class Late(StreamingQueryListener):
    """Counts, by query id, what the state operators of a session's queries dropped as late: rows after each task's own aggregation."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):  # noqa: N802
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):  # noqa: N802
        own = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + own

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def run(stream: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, int]:
    """All there is in the stream's source, windows that ended as Parquet and read back; and how many late rows were dropped."""
    session, late = stream.sparkSession, Late()
    session.streams.addListener(late)
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        # listeners are told in the background; the query's own progress is complete up to its hundred last batches
        dropped = sum(int(s.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for s in _plain(p).get("stateOperators", ()))
    finally:
        session.streams.removeListener(late)
    return session.read.schema(stream.schema).parquet(path), max(dropped, late.dropped.get(str(query.id), 0))


def _plain(progress) -> dict:
    import json

    return json.loads(progress.json) if hasattr(progress, "json") else progress
