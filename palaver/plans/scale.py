"""Queries of operators whose input may be one large file, run, stream or vocabulary; added by import."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions import sql
from palaver.functions import text as T
from palaver.operators import dictionary, messages, tokens
from palaver.plans.registry import ORACLE, W, digest_of, ev, query, strip_sql, table
from palaver.sources import chat, digests, token_files
from palaver.streaming import bridge, windows
from palaver.streaming.dedup import folder as new_folder
from palaver.streaming.dedup import run_available


@query("""WITH b AS (SELECT conv_id, turn, role, i, CAST('0x' || substr(hex(encode(text)), CAST(2 * i - 1 AS INTEGER), 2) AS BIGINT) + 4 AS id
  FROM conversations, unnest(range(1, strlen(text) + 1)) AS u(i)),
f AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn, i) - 1 AS place FROM b)
SELECT place // 512 * 512 AS start, count(*) AS n_ids, CAST(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS BIGINT) AS n_loss,
  sha256(string_agg(id, ',' ORDER BY place)) AS ids FROM f GROUP BY 1""")
def token_blocks(spark, folder):
    """Turns as flat token and mask files, read back in blocks; replies of the assistant count for the loss."""
    rows = table(spark, folder, "conversations").withColumn("ids", tokens.byte_ids("text", 4))
    loss = (F.col("role") == "assistant").cast("int")
    path = new_folder(spark, "tokens")
    token_files.write(rows.withColumn("mask", F.transform("ids", lambda _: loss)), path, ["conv_id", "turn"])
    blocks = token_files.read(spark, path, block=512)
    n_loss = F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return blocks.select("start", F.size("ids").cast("bigint").alias("n_ids"), n_loss.alias("n_loss"), digest_of("ids").alias("ids"))


#: Lines of an export for each kind of event, and the text that a message keeps of them.
LINES = {
    "view": (["{time}, u{user} : {props}", "", "goes on"], "{props}\n\ngoes on"),
    "click": (["{time}, u{user} : {props}", "2024년 1월 1일 월요일", "more"], "{props}\nmore"),
    "signup": (["{time}, u{user} : {props}", "Saved Date : 2024"], "{props}"),
    "purchase": (["{time}, u{user} : ", ""], None),
    "error": (["{time}: u{user} left", "no message is open here"], None),
}
SIZES = "CASE event_type " + " ".join(f"WHEN '{kind}' THEN {len(lines)}" for kind, (lines, _) in LINES.items()) + " END"
KEPT = "CASE event_type " + " ".join(f"WHEN '{kind}' THEN " + (f"replace('{text}', '{{props}}', props)" if text else "NULL") for kind, (_, text) in LINES.items()) + " END"


@query(f"""WITH e AS (SELECT *, user_id % 4 AS room, {SIZES} AS n FROM events),
p AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY room ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS seq FROM e)
SELECT room, CAST(seq AS BIGINT) AS seq, date_trunc('minute', ts) AS ts, 'u' || user_id AS speaker, {KEPT} AS text FROM p WHERE {KEPT} IS NOT NULL""")
def parse_ranges(spark, folder):
    """Events as one export file in parts a room, with system, blank, date and marker lines, parsed by ranges of 8,192 bytes."""
    events = table(spark, folder, "events").withColumn("room", F.col("user_id") % 4)
    time = F.date_format("ts", "yyyy. M. d. H:mm")

    def filled(line: str):
        for name, value in (("{time}", time), ("{user}", F.col("user_id").cast("string")), ("{props}", F.col("props"))):
            head, found, rest = line.partition(name)
            if found:
                return F.concat(filled(head), value, filled(rest))
        return F.lit(line)

    of = F.coalesce(*(F.when(F.col("event_type") == kind, F.array(*map(filled, lines))) for kind, (lines, _) in LINES.items()))
    rows = events.select("room", "ts", "event_id", of.alias("lines"))
    title = events.select("room").distinct().select("room", F.lit("2000-01-01").cast("timestamp_ntz").alias("ts"), F.lit(-1).cast("bigint").alias("event_id"), F.array(F.lit("room 카카오톡 대화")).alias("lines"))
    rows, path = rows.union(title).repartitionByRange("room", "ts", "event_id").sortWithinPartitions("room", "ts", "event_id"), new_folder(spark, "exports")
    rows.select("room", F.explode("lines").alias("value")).write.mode("overwrite").partitionBy("room").text(path)
    found, _ = chat.export_messages(spark, path, split=8_192, parts=True)
    return found.select(F.regexp_extract("path", "room=([0-9]+)", 1).cast("bigint").alias("room"), "seq", "ts", "speaker", "text")


ROOMS = """e AS (SELECT 'room_' || (user_id % 8) AS room, event_id AS seq, event_type || props AS uid, epoch(date_trunc('second', ts)) AS sec,
  event_type IN ('view', 'click') AS wants, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS k FROM events)"""


@query(f"""WITH RECURSIVE {ROOMS},
s(room, k, seq, uid, action, seen, sends) AS (
  SELECT DISTINCT room, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), '', 'none', CAST([] AS VARCHAR[]), CAST([] AS DOUBLE[]) FROM e
  UNION ALL
  SELECT room, k, seq, uid, CASE WHEN NOT fresh THEN 'none' WHEN NOT wants THEN 'context' WHEN free THEN 'reply' ELSE 'limited' END,
    CASE WHEN fresh THEN list_slice(list_append(seen, uid), greatest(len(seen) + 1 - 100, 0) + 1, len(seen) + 1) ELSE seen END,
    CASE WHEN fresh AND wants AND free THEN list_append(near, sec) WHEN fresh AND wants THEN near ELSE sends END
  FROM (SELECT *, len(near) < 2 AND (len(near) = 0 OR sec - near[-1] >= 600) AS free
    FROM (SELECT e.*, s.seen, s.sends, NOT list_contains(s.seen, e.uid) AS fresh, list_filter(s.sends, lambda x: e.sec - x < 3600) AS near
      FROM s JOIN e ON e.room = s.room AND e.k = s.k + 1)))
SELECT room, seq, uid, action FROM s WHERE action <> 'none'""")
def stream_actions(spark, folder):
    """What a bridge does about every new message of its rooms, in a stream with state: 100 ids remembered, 2 replies an hour."""
    base = new_folder(spark, "actions")
    events = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    at = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    rows = events.select(
        F.concat(F.lit("room_"), F.col("user_id") % 8).alias("room"), F.col("event_id").alias("seq"), F.concat("event_type", "props").alias("uid"),
        at.alias("at"), F.col("event_type").isin("view", "click").alias("wants_reply"),
    )
    found = bridge.actions(rows, most=100, per_hour=2, spacing=600.0, per_batch=1 << 40, first_is_old=False)
    return run_available(found, f"{base}/out", f"{base}/state")


@query("""WITH RECURSIVE e AS (SELECT 'room_' || (user_id % 8) AS room, event_id AS seq, CASE WHEN event_id < 200 THEN 1.0 ELSE value / 500 END AS sure,
  row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS k FROM events),
s(room, k, seq, fallback, past) AS (
  SELECT DISTINCT room, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), false, CAST([] AS BOOLEAN[]) FROM e
  UNION ALL
  SELECT room, k, seq, own, list_slice(list_append(past, own), greatest(len(past) + 1 - 41, 0) + 1, len(past) + 1)
  FROM (SELECT e.room, e.k, e.seq, s.past, e.sure < 0.5 AND len(s.past) > 0 AND len(list_filter(s.past, lambda x: x)) / len(s.past) < 0.3001 AS own
    FROM s JOIN e ON e.room = s.room AND e.k = s.k + 1))
SELECT room, seq, fallback FROM s WHERE k > 0""")
def stream_fallbacks(spark, folder):
    """Fallbacks by a rolling share of the last 41 decisions, in a stream with state; no share of so many is the target, so nothing is drawn."""
    base = new_folder(spark, "fallbacks")
    events = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    # the first decisions, before there is a share, are certain ones
    sure = F.when(F.col("event_id") < 200, 1.0).otherwise(F.col("value") / 500)
    rows = events.select(F.concat(F.lit("room_"), F.col("user_id") % 8).alias("room"), F.col("event_id").alias("seq"), sure.alias("confidence"))
    return run_available(bridge.fallbacks(rows, target=0.3001, window=41), f"{base}/out", f"{base}/state")


WINDOWS = {"tumbling": {"size": "6 hours"}, "sliding": {"size": "12 hours", "slide": "6 hours"}, "session": {"gap": "3 hours"}}


@query("""WITH e AS (SELECT user_id % 4 AS room, event_id, ts FROM events),
b AS (SELECT room, event_id, ts, time_bucket(INTERVAL 6 hours, ts, TIMESTAMP '1970-01-01') AS t FROM e),
w AS (SELECT 'tumbling' AS kind, room, event_id, t AS started, t + INTERVAL 6 hours AS ended FROM b
  UNION ALL SELECT 'sliding', room, event_id, t - INTERVAL 6 hours * i, t + INTERVAL 12 hours - INTERVAL 6 hours * i FROM b, unnest([0, 1]) AS u(i)
  UNION ALL SELECT 'session', room, event_id, min(ts) OVER p, max(ts) OVER p + INTERVAL 3 hours FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY room ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY room ORDER BY ts, event_id) <= INTERVAL 3 hours THEN 0 ELSE 1 END AS fresh FROM e)) WINDOW p AS (PARTITION BY room, s))
SELECT kind, room, started, ended, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM w
WHERE ended <= (SELECT max(ts) - INTERVAL 1 hour FROM events) GROUP BY ALL""")
def stream_windows(spark, folder):
    """Events in windows of three kinds through a stream of three batches, the last one of rows that come late and count nowhere."""
    base = new_folder(spark, "windows")
    events = table(spark, folder, "events").select((F.col("user_id") % 4).alias("room"), "event_id", "ts")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    half = first + (last - first) / 2
    # the source takes files in the order they were written, eight a batch
    old = events.where(F.col("ts") < first + (last - first) / 10).withColumn("event_id", -F.col("event_id") - 1)
    for rows in (events.where(F.col("ts") < half), events.where(F.col("ts") >= half), old):
        rows.repartition(8).write.mode("append").parquet(f"{base}/in")
    out = []
    for kind, options in WINDOWS.items():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(f"{base}/in")
        sums = [F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")]
        found, _ = windows.run(windows.windowed(stream, "ts", ["room"], sums, delay="1 hour", **options), f"{base}/{kind}", f"{base}/{kind}-state")
        out.append(found.select(F.lit(kind).alias("kind"), "room", "started", "ended", "n", "ids"))
    return out[0].union(out[1]).union(out[2])


@query("""WITH t AS (SELECT token, 3 + row_number() OVER (ORDER BY token) AS id FROM (SELECT DISTINCT '<|spk:u' || user_id || '|>' AS token FROM events WHERE event_type <> 'error'))
SELECT event_id, coalesce(id, 3) AS token_id FROM events LEFT JOIN t ON token = '<|spk:u' || user_id || '|>'""")
def speaker_ids(spark, folder):
    """Ids of a vocabulary learned from the users of all events but errors, saved, loaded and looked up for every event."""
    events = table(spark, folder, "events").withColumn("speaker", F.concat(F.lit("u"), "user_id"))
    path = new_folder(spark, "vocabulary")
    dictionary.save(dictionary.learn(events.where("event_type <> 'error'")), path)
    return dictionary.look_up(events, dictionary.load(spark, path)).select("event_id", "token_id")


@query("""SELECT lang, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes,
CAST(sum(len(text) - len(replace(text, chr(10), '')) + 1) AS BIGINT) AS line_count FROM documents GROUP BY 1""")
def file_digests(spark, folder):
    """A text file in parts for each language, hashed and counted in bounded buffers."""
    path = new_folder(spark, "files")
    rows = table(spark, folder, "documents").repartitionByRange("lang", "doc_id").sortWithinPartitions("lang", "doc_id")
    rows.select("lang", "text").write.mode("overwrite").partitionBy("lang").text(path)
    return digests.digests(spark, path, parts=True).select(F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang"), "sha256", "bytes", "line_count")


#: Line ends and blanks that texts of the tables lack, put in after each full stop.
MARKED = "replace(text, '. ', '.' || chr(160) || chr(13) || chr(10) || chr(8203) || chr(9) || chr(13))"
LINE_SQL = strip_sql(f"replace(replace(regexp_replace({MARKED}, '\\r\\n?', chr(10), 'g'), chr(160), ' '), chr(8203), '')")


@query(f"WITH s AS (SELECT doc_id, {LINE_SQL} AS line FROM documents) SELECT doc_id, sha256(line) AS line, sha256({strip_sql(f"regexp_replace(line, '{W}+', ' ', 'g')")}) AS response FROM s")
def trainer_lines(spark, folder):
    """Texts as a trainer cleans them, with their lines and as one line."""
    marked = F.replace("text", F.lit(". "), F.lit(".\u00a0\r\n\u200b\t\r"))
    rows = table(spark, folder, "documents").select("doc_id", marked.alias("text"))
    return rows.select("doc_id", F.sha2(T.sanitize_line("text"), 256).alias("line"), F.sha2(T.one_line_response("text"), 256).alias("response"))


@query(ORACLE["cpt_chunks"])
def sql_chunks(spark, folder):
    """Chunks of sessions by the table function, called from SQL."""
    sql.register(spark)
    messages.sessions(ev(spark, folder)).createOrReplaceTempView("session_messages")
    return spark.sql("""SELECT * FROM chunks(TABLE(
        SELECT source_file, session_index, ts, seq, concat(speaker, ': ', one_line(text)) AS line FROM session_messages), 8, 4, 4, 60, 600)""")
