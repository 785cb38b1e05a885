"""Shared steps: durable cuts of the lineage, folders that the cluster shares, broadcasts, ranks and joins without a hot task."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _path(session, path: str):
    return session._jvm.org.apache.hadoop.fs.Path(path)


def _files(session, path: str):
    return _path(session, path).getFileSystem(session._jsc.hadoopConfiguration())


def shared_folder(session) -> str:
    """The cluster's checkpoint folder, from `spark.checkpoint.dir`.

    Where that is unset, as in tests, a temporary folder is taken, but only if driver and executors are one process.
    Spark gives every driver a subfolder of its own there, which goes when the driver ends.
    """
    context = session.sparkContext
    if not context.getCheckpointDir():
        named = session.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    _files(session, context.getCheckpointDir()).deleteOnExit(_path(session, context.getCheckpointDir()))
    return context.getCheckpointDir().rstrip("/")


def new_folder(session, name: str) -> str:
    """A new folder in the shared one, deleted when the driver ends."""
    path = f"{shared_folder(session)}/{name}-{uuid.uuid4().hex}"
    _files(session, path).mkdirs(_path(session, path))
    _files(session, path).deleteOnExit(_path(session, path))
    return path


def delete(session, path: str) -> None:
    _files(session, path).delete(_path(session, path), True)


def cut(df: DataFrame) -> DataFrame:
    """A copy in the cluster's shared checkpoint folder; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def uncut(df: DataFrame) -> None:
    """Deletes the files of a copy that `cut` made and that nothing reads any more."""
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        delete(df.sparkSession, file.get())


@contextmanager
def settings(session, values: dict):
    """Settings that hold inside, and are as before afterwards."""
    before = {k: session.conf.get(k, None) for k in values}
    for k, v in values.items():
        session.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            session.conf.unset(k) if v is None else session.conf.set(k, v)


class Scratch:
    """Tables written as Parquet under the shared folder, deleted by `drop`."""

    def __init__(self, session):
        self.session, self.folder = session, new_folder(session, "scratch")

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        # the shuffles of what has been stored aren't read again
        with settings(self.session, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            df.write.parquet(path)
        return self.session.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete(self.session, self.folder)


class Shared:
    """A broadcast of any object, pickled by value: executors need no copy of this package.  Each worker process unpickles it once."""

    def __init__(self, session, value):
        self.held = session.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self.held, "unpickled"):
            self.held.unpickled = cloudpickle.loads(self.held.value)
        return self.held.unpickled


def partitions(session) -> int:
    return max(1, int(session.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, groups: list[str], order: list[str], into: str, few: bool = True) -> DataFrame:
    """Rows numbered from 0 without gaps within `groups`, by `order` (nulls first).

    The rows are dealt by sampled ranges of (groups, order), so a hot group is spread over tasks whatever its
    values are.  A row's number is its place in its range plus the group's rows in the ranges before: one row for each
    group and range that holds it, which is broadcast if there are few groups (as many as shards or lengths).
    """
    laid = df.repartitionByRange(partitions(df.sparkSession), *groups, *order).sortWithinPartitions(*groups, *order)
    laid = cut(laid.withColumn("_at", F.monotonically_increasing_id()))
    # the id's upper bits are the range's number
    own = F.shiftright("_at", 33)
    counts = laid.groupBy(*groups, own.alias("_range")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = counts.select(*(F.col(g).alias(f"_{g}") for g in groups), F.col("_range"), shift.alias("_shift"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    joined = laid.join(F.broadcast(starts) if few else starts, [own == F.col("_range"), *same])
    return joined.withColumn(into, (F.col("_at") + F.col("_shift")).cast("bigint")).drop("_at", "_range", "_shift", *(f"_{g}" for g in groups))


#: A key with more than this share of all rows is hot; there are at most so many.
HOT_KEYS = 4_096


def attach(rows: DataFrame, table: DataFrame, key: str, columns: list[str], total: int, spread: Column) -> DataFrame:
    """`rows` with the `columns` of the row of `table` that has their `key`, null without one.

    `table` has one row a key and `_n`, how many of the `total` rows have it.  The keys that hold more than a
    HOT_KEYS-th of the rows are fewer than HOT_KEYS, so they are broadcast; rows of the others are shuffled by
    their key, and those that need no partner (hot or null keys) by `spread`, so no task gets a key's share.
    """
    hot = F.col("_n") * HOT_KEYS > total
    warm = F.broadcast(table.where(hot).select(F.col(key).alias("_hot"), *(F.col(c).alias(f"_hot_{c}") for c in columns)))
    first = rows.join(warm, F.col(key) == F.col("_hot"), "left")
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    first = first.withColumns({"_own": settled.cast("int"), "_deal": F.when(settled, spread.cast("string")).otherwise(F.col(key).cast("string"))})
    cold = table.where(~hot).select(F.lit(0).alias("_own"), F.col(key).cast("string").alias("_deal"), *(F.col(c).alias(f"_cold_{c}") for c in columns))
    joined = first.join(cold, ["_own", "_deal"], "left")
    return joined.select(*rows.columns, *(F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in columns))
