"""What stored tables and checkpoints leave behind."""

import os

from pyspark.sql import functions as F


def local(path: str) -> str:
    return path.removeprefix("file:")


def checkpoints(spark) -> set:
    from palaver.llm.common import shared_folder

    return {name for name in os.listdir(local(shared_folder(spark))) if name.startswith("rdd-")}


def test_components_leave_one_checkpoint(spark):
    from palaver.llm.components import components

    before = checkpoints(spark)
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(edges)
    assert {(r.node, r.component) for r in found.collect()} == {(k, 0) for k in range(301)}
    assert len(checkpoints(spark) - before) == 1


def test_deleted_copy(spark):
    from palaver.llm.common import cut, uncut

    before = checkpoints(spark)
    copy = cut(spark.range(10))
    assert copy.count() == 10 and len(checkpoints(spark) - before) == 1
    uncut(copy)
    assert checkpoints(spark) == before


def test_store_restores_settings_and_frees_its_shuffles(spark):
    from palaver.llm.common import Scratch

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    known = spark.conf.get(name)
    scratch = Scratch(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    stored = scratch.store(counted, "counted")
    assert spark.conf.get(name) == known
    # the frame that was stored may still be read: its shuffle is made anew
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, counted.collect())) == [(k, 100) for k in range(10)]
    scratch.drop()
