"""SQL functions against the column functions, chunks against plain Python, and the run log."""

import random

import pytest
from pyspark.sql import functions as F

from palaver.functions import sql
from palaver.functions import text as T
from palaver.streaming import log


def test_scalar_functions(spark):
    sql.register(spark)
    rng = random.Random(1)
    parts = ["a", "é", " ", "  ", "\t", "\n", "\r\n", "\r", " ", "　", "\x1c", "​", "@kim", "@가.나", "'", "\\", "$1"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(12))),) for _ in range(400)] + [(None,), ("",)]
    spark.createDataFrame(rows, "t string").createOrReplaceTempView("texts")
    df = spark.sql("SELECT t, one_line(t) AS a, compact_length(t) AS b, mentions(t) AS c FROM texts")
    wrong = df.where(~(F.col("a").eqNullSafe(T.one_line("t")) & F.col("b").eqNullSafe(T.compact_length("t")) & F.col("c").eqNullSafe(T.count_mentions("t"))))
    assert wrong.collect() == []
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("window", "stride", "least"), [(4, 2, 1), (3, 5, 2), (50, 1, 3), (1, 1, 1)])
def test_chunks(spark, window, stride, least):
    sql.register(spark)
    rng = random.Random(2)
    sizes = {"a": 23, "b": 1, "c": 4, None: 6}
    rows = [(k, f"{i % 3}", i // 2, i, rng.choice(["", "x", " yy ", "zzz　", None])) for k, n in sizes.items() for i in range(n)]
    spark.createDataFrame(rows, "room string, other string, ts bigint, seq bigint, line string").createOrReplaceTempView("lines")
    got = spark.sql(f"SELECT * FROM chunks(TABLE(SELECT room, ts, seq, line FROM lines), {window}, {stride}, {least}, 3, 6)")
    want = []
    for k in sizes:
        own = [r[4] or "" for r in rows if r[0] == k]
        for start in range(0, len(own), stride):
            part = own[start : start + window]
            if len(part) >= least:
                text = "\n".join(part).strip(T.WS_CHARS)
                text = text[:6].rstrip(T.WS_CHARS) if len(text) > 6 else text
                want.append((k, start, len(part), text, "short_chunk" if len("".join(c for c in text if c not in T.WS_CHARS)) < 3 else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # more keys, and none
    assert spark.sql(f"SELECT * FROM chunks(TABLE(lines), {window}, {stride}, {least}, 3, 6)").columns == ["room", "other", "start", "message_count", "text", "reason"]
    assert spark.sql(f"SELECT count(*) FROM chunks(TABLE(SELECT ts, seq, line FROM lines), 100, 100, {least}, 3, 6)").first()[0] == 1


def test_chunks_of_other_tables_are_refused(spark):
    sql.register(spark)
    with pytest.raises(Exception, match="lacks line"):
        spark.sql("SELECT * FROM chunks(TABLE(SELECT 1 AS ts, 2 AS seq), 1, 1, 1, 1, 1)")
    with pytest.raises(Exception, match="1 or more"):
        spark.sql("SELECT * FROM chunks(TABLE(SELECT 1 AS ts, 2 AS seq, '' AS line), 0, 1, 1, 1, 1)")


def test_run_log(spark, tmp_path):
    """A batch that fails after its entry was written, or is run again, leaves one entry."""
    source, folder, failed = tmp_path / "in", str(tmp_path / "log"), []
    for n in (3, 5):
        spark.range(n).coalesce(1).write.mode("append").parquet(str(source))

    def then(rows, batch):
        log.append(rows.agg(F.lit(-1).cast("bigint").alias("n")), folder, batch)
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("lost")

    for _ in range(2):
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(source))
        query = log.logged(stream, folder, log.counts(), then).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception:  # noqa: BLE001
            assert failed == [1]
    assert [tuple(r) for r in log.entries(spark, folder, "n bigint").collect()] == [(0, 3), (1, 5)]
