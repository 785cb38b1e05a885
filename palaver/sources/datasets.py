"""Datasets on disk: JSON lines and JSON documents; token and mask files are in `token_files`."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def write_lines(df: DataFrame, path: str, order: list[str], mode: str = "error", keep: list[str] | None = None) -> None:
    """JSON lines in order, of the columns to `keep`: the files' names sort as their rows do, each file is written by its own task."""
    df.orderBy(*order).select(*(keep or df.columns)).write.mode(mode).json(path)


def read_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines by a given schema, so no pass infers one; a missing path is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_document(row: DataFrame, path: str) -> None:
    """A frame of one row, such as statistics, as an indented JSON document."""
    found = row.limit(2).toJSON().collect()
    if len(found) != 1:
        raise ValueError("one row is needed")
    Path(path).write_text(json.dumps(json.loads(found[0]), ensure_ascii=False, indent=2), encoding="utf-8")


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)
