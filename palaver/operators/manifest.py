"""File inventories, manifests and configurations as tables."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def inventory(rows: DataFrame, name: str, text: str, order: str) -> DataFrame:
    """A row a name: digest, bytes and lines of its texts in order, one below the other; null texts are left out.

    A digest is one walk over a name's bytes, so a name is one task's work, but the texts stream through it in batches and are
    never put together.
    """
    kind = rows.schema[name].dataType.simpleString()
    laid = rows.select(F.col(name).alias("_name"), F.col(order).alias("_order"), F.col(text).alias("_text")).where("_text is not null")
    # names without any text are there too
    none = rows.groupBy(F.col(name).alias("_name")).agg(F.count(text).alias("_n")).where("_n = 0").select("_name", F.sha2(F.lit(""), 256).alias("sha256"), F.lit(0).cast("bigint").alias("bytes"), F.lit(1).cast("bigint").alias("line_count"))
    laid = laid.repartition("_name").sortWithinPartitions("_name", "_order", "_text").select("_name", "_text")

    def run(batches):
        last, digest, n, lines = None, None, 0, 0
        schema = None

        def row():
            values = ([last.as_py()], [digest.hexdigest()], [n], [lines + 1])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (schema.field(0).type, pa.string(), pa.int64(), pa.int64()), strict=True)], names=["_name", "sha256", "bytes", "line_count"])

        for batch in batches:
            schema = batch.schema
            for key, value in zip(*batch.columns, strict=True):
                data = value.as_py().encode()
                if digest is None or key != last:
                    if digest:
                        yield row()
                    last, digest, n, lines = key, hashlib.sha256(), 0, 0
                else:
                    data = b"\n" + data
                digest.update(data)
                n, lines = n + len(data), lines + data.count(b"\n")
        if digest:
            yield row()

    found = laid.mapInArrow(run, f"_name {kind}, sha256 string, bytes bigint, line_count bigint")
    return found.union(none).withColumnRenamed("_name", name)


def not_recorded(plan: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    return plan.join(manifest, keys, "left_anti")


def numbered_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """`unique_name`: the name, with __2, __3, ... from its second row on."""
    k = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return df.withColumn("unique_name", F.when(k == 1, F.col(name)).otherwise(F.concat(name, F.lit("__"), k.cast("string"))))


def config_diff(old: DataFrame, new: DataFrame, fixed: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose values differ; a missing one reads <missing>."""
    both = old.select("key", F.col("value").alias("old")).join(new.select("key", F.col("value").alias("new")), "key", "full_outer")
    both = both.select("key", F.coalesce("old", F.lit("<missing>")).alias("old"), F.coalesce("new", F.lit("<missing>")).alias("new")).where("old <> new")
    locked = F.lit(False)
    for prefix in fixed:
        locked = locked | F.col("key").startswith(prefix)
    return both.withColumn("immutable", locked)


def summary(plan: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """How many items a plan has, and how many of them a run would create and skip as recorded."""
    known = manifest.select(*keys).distinct().withColumn("_known", F.lit(True))
    skipped = F.count_if(F.col("_known").isNotNull())
    return plan.join(known, keys, "left").agg(F.count(F.lit(1)).alias("planned"), (F.count(F.lit(1)) - skipped).alias("created"), skipped.alias("skipped"))


def listed(files: DataFrame, name: str, exclude: tuple[str, ...] = (), suffix: str = ".txt") -> DataFrame:
    """Files of one suffix, in any case, but the excluded ones."""
    rows = files.where(F.lower(name).endswith(suffix.lower()))
    return rows.where(~F.col(name).isin(*exclude)) if exclude else rows
