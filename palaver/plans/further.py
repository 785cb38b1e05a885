"""Further queries of the engine: turns, context examples, cascades with options, orders, summaries, streams; added by import."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palaver.functions import replies
from palaver.functions import text as T
from palaver.functions import turns
from palaver.operators import dialogue, manifest, messages, rooms, tokens, vocabulary
from palaver.plans.more import VOCABULARY
from palaver.plans.registry import CONTEXT, DROPS, SESSIONS, W, _contexts, compact_sql, cv, ev, ln, one_line_sql, query, strip_sql, table
from palaver.sources import chat
from palaver.streaming import bridge
from palaver.streaming import dedup as streams

NAMES = ("assistant", "user")
RAW = """CASE turn % 5 WHEN 0 THEN '<|bos|><|spk:assistant|> ' || text || '<|eos|> tail' WHEN 1 THEN ' assistant : ' || text || chr(10) || ' user: next'
WHEN 2 THEN '[Assistant]: ' || text || chr(10) || '(user) next' WHEN 3 THEN '<B> ' || text || ' <U> next' ELSE 'SPK_user ' || text || ' <|spk:user|> next' END"""


def _raw():
    wrap = lambda *parts: F.concat(*(F.col(p) if p == "text" else F.lit(p) for p in parts))
    kind = F.col("turn") % 5
    return (
        F.when(kind == 0, wrap("<|bos|><|spk:assistant|> ", "text", "<|eos|> tail")).when(kind == 1, wrap(" assistant : ", "text", "\n user: next"))
        .when(kind == 2, wrap("[Assistant]: ", "text", "\n(user) next")).when(kind == 3, wrap("<B> ", "text", " <U> next"))
        .otherwise(wrap("SPK_user ", "text", " <|spk:user|> next"))
    )


@query(f"SELECT conv_id, turn, split_part({RAW}, CASE turn % 5 WHEN 0 THEN '<|eos|>' WHEN 1 THEN chr(10) || ' user:' WHEN 2 THEN chr(10) || '(user)' WHEN 3 THEN '<U>' ELSE '<|spk:' END, 1) AS turn_text FROM conversations")
def turn_cut(spark, folder):
    """Generated text up to the next turn, in five dialects."""
    return table(spark, folder, "conversations").select("conv_id", "turn", turns.cut_at_next_turn(_raw(), NAMES).alias("turn_text"))


@query(f"SELECT conv_id, turn, {strip_sql('text')} AS reply FROM conversations")
def turn_reply(spark, folder):
    """The same turn without what names its speaker: the text that the dialects were put around."""
    cut = turns.cut_at_next_turn(_raw(), NAMES)
    return table(spark, folder, "conversations").select("conv_id", "turn", T.strip(turns.strip_speaker(cut, NAMES)).alias("reply"))


@query("""WITH m AS (SELECT conv_id, 0 AS place, 'system' AS role, 'Be kind.' AS content FROM (SELECT DISTINCT conv_id FROM conversations)
UNION ALL SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn), CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END, text FROM conversations) SELECT * FROM m""")
def chat_messages(spark, folder):
    packed = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    each = packed.select("conv_id", F.posexplode(turns.chat_messages(F.col("all"), "Be kind.", bot="assistant")).alias("place", "m"))
    return each.select("conv_id", F.col("place").cast("bigint").alias("place"), "m.role", "m.content")


@query("""WITH r AS (SELECT conv_id, turn, '<|bos|><|spk:' || CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'UNKNOWN' END || '|>' || text || '<|eos|>' || chr(10) AS line, strlen(text) + 4 AS k, strlen(text) + 2 AS own,
length(regexp_replace(text, '\\s', '', 'g')) AS n FROM conversations),
w AS (SELECT *, row_number() OVER o - 1 AS pos, coalesce(list(line) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), []) AS before,
coalesce(sum(k) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0) AS past FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, pos, CAST(past + k AS BIGINT) AS n_ids, own AS n_loss, array_to_string(before, '') || line AS decoded FROM w WHERE pos >= 1 AND (pos - 1) % 2 = 0 AND n >= 2 AND len(before) >= 1""")
def context_example_ids(spark, folder):
    """Context examples as ids with a loss mask of the target alone; decoded again to show their values."""
    rows = vocabulary.context_examples(cv(spark, folder), ["conv_id"], VOCABULARY, turns=4, least=1, stride=2)
    loss = F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return rows.select("conv_id", F.col("pos").cast("bigint").alias("pos"), F.size("ids").cast("bigint").alias("n_ids"), loss.alias("n_loss"), VOCABULARY.decode(F.col("ids")).alias("decoded"))


MENTION_SQL = "@[A-Za-z0-9_.\\-가-힣]+"
TIDY = f"trim(regexp_replace(regexp_replace(regexp_replace(t, '{MENTION_SQL}', '', 'g'), '[ \\t]{{2,}}', ' ', 'g'), '{W}*([,;:]){W}*', '\\1 ', 'g'), ' ' || chr(9) || ',;:')"


@query(f"""{DROPS}, q AS (SELECT doc_id, line_no, full_text, CASE WHEN regexp_matches(t, '{MENTION_SQL}') THEN {TIDY} ELSE t END AS t FROM b)
SELECT doc_id, line_no, t AS text, CASE WHEN full_text = '' THEN 'empty_after_clean' WHEN length({compact_sql('t')}) < 8 THEN 'short_message' END AS reason FROM q""")
def cascade_options(spark, folder):
    """The cascade with mentions taken out first and only two of its tests."""
    rows = messages.cascade(ln(spark, folder), shortest=8, without_mentions=True, checks=("empty_after_clean", "short_message"))
    return rows.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "text", "reason")


@query(f"""{CONTEXT}, k AS (SELECT conv_id, pos FROM x WHERE reason IS NULL ORDER BY conv_id, pos LIMIT 50), stop AS (SELECT max(conv_id * 1000 + pos) AS last FROM k)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM x, stop WHERE conv_id * 1000 + pos <= last GROUP BY 1""")
def counts_to_cap(spark, folder):
    """Drop counters that stand still once the cap is reached."""
    return messages.counted_to_cap(_contexts(spark, folder), ["conv_id", "pos"], 50)


@query(f"""{SESSIONS}, e AS (SELECT *, min(ts) OVER (PARTITION BY source_file, session_index) AS start FROM s)
SELECT source_file, seq, row_number() OVER (ORDER BY start, source_file, session_index, ts, seq) - 1 AS place FROM e""")
def flat_order(spark, folder):
    return messages.flat_order(messages.sessions(ev(spark, folder))).select("source_file", "seq", F.col("place").cast("bigint").alias("place"))


@query("SELECT count(*) AS planned, count(*) FILTER (NOT known) AS created, count(*) FILTER (known) AS skipped FROM (SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS known FROM documents d)")
def manifest_summary(spark, folder):
    return manifest.summary(table(spark, folder, "documents").select("doc_id"), table(spark, folder, "labels").select("doc_id"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE lang NOT IN ('fr') AND lower(source) LIKE '%1'")
def file_filter(spark, folder):
    rows = table(spark, folder, "documents")
    return manifest.listed(rows, "source", suffix="1").where(~F.col("lang").isin("fr")).select("doc_id", "lang")


@query(f"""SELECT conv_id, turn, CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'user' END AS speaker, {strip_sql(one_line_sql('text'))} AS text FROM
(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations WHERE {strip_sql('text')} <> '') WHERE back <= 4""")
def prepared_history(spark, folder):
    """The last turns as a dialogue of known speakers, sanitised, without empty ones."""
    rows = dialogue.prepared(table(spark, folder, "conversations"), NAMES, user="user", bot="assistant", turns=2, budget=1 << 30)
    return rows.select("conv_id", "turn", "speaker", "text")


@query("SELECT conv_id, turn, CASE WHEN role IN ('assistant', 'user') THEN role ELSE 'user' END AS user_name, CASE WHEN turn % 2 = 0 AND role IN ('assistant', 'user') THEN role ELSE 'assistant' END AS bot_name FROM conversations")
def dialogue_speakers(spark, folder):
    given = F.when(F.col("turn") % 2 == 0, F.col("role"))
    user, bot = turns.speakers_of(F.concat(F.lit(" "), "role"), given, NAMES)
    return table(spark, folder, "conversations").select("conv_id", "turn", user.alias("user_name"), bot.alias("bot_name"))


@query("SELECT conv_id, turn, coalesce(CASE WHEN turn % 3 = 0 THEN 'given' END, CASE WHEN turn % 3 = 1 THEN 'best' END, role) AS path FROM conversations")
def resolved_paths(spark, folder):
    path = turns.first_of(F.when(F.col("turn") % 3 == 0, "given"), F.when(F.col("turn") % 3 == 1, "best").otherwise(" "), F.col("role"))
    return table(spark, folder, "conversations").select("conv_id", "turn", path.alias("path"))


@query("""WITH s AS (SELECT doc_id, toxic = 1 AS has_checkpoint, quality = 0 AS fresh, CASE doc_id % 4 WHEN 0 THEN NULL ELSE doc_id % 4 = 1 END AS stopped, CASE doc_id % 4 WHEN 0 THEN NULL ELSE doc_id % 4 = 2 END AS completed,
CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'adapter_best' END AS adapter FROM labels)
SELECT doc_id, CASE WHEN has_checkpoint THEN CASE WHEN fresh THEN 'abort_fresh' ELSE 'sft' END WHEN completed IS NULL THEN 'cpt' WHEN stopped THEN 'wait_stopped' WHEN NOT completed THEN 'wait_incomplete'
WHEN adapter <> '' THEN 'sft_from_adapter' ELSE 'abort_no_adapter' END AS stage FROM s""")
def training_stage(spark, folder):
    kind = F.col("doc_id") % 4
    state = lambda k: F.when(kind != 0, kind == k)
    adapter = F.when(F.col("doc_id") % 3 == 0, "").otherwise("adapter_best")
    stage = turns.next_stage(has_checkpoint=F.col("toxic") == 1, fresh=F.col("quality") == 0, stopped=state(1), completed=state(2), adapter=adapter)
    return table(spark, folder, "labels").select("doc_id", stage.alias("stage"))


@query("SELECT 'conv_' || conv_id AS source_file, 'bad time: 2024. 13. 1. 9:00' AS reason FROM conversations WHERE conv_id % 3 = 0 GROUP BY conv_id")
def parse_errors(spark, folder):
    """Exports of which every third one has a message of a thirteenth month."""
    bad = F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") > 0), "2024. 13. 1. 9:00").otherwise("2024. 1. 1. 9:00")
    line = F.concat(bad, F.lit(", "), "speaker", F.lit(" : "), "text")
    packed = cv(spark, folder).groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    return chat.parse_errors(packed)


@query("SELECT room, count(*) AS n FROM (SELECT DISTINCT 'room_' || (user_id % 8) AS room, event_type || '/' || user_id AS uid FROM events) GROUP BY 1")
def stream_new_messages(spark, folder):
    """New messages of every room through a stream with state: each id once."""
    base = streams.folder(spark, "bridge")
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    at = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    room = F.concat(F.lit("room_"), F.col("user_id") % 8)
    rows = stream.select(room.alias("room"), F.col("event_id").alias("seq"), F.concat_ws("/", "event_type", "user_id").alias("uid"), at.alias("at"), (F.col("event_type") == "view").alias("wants_reply"))
    found = streams.run_available(bridge.actions(rows, most=1 << 20), f"{base}/out", f"{base}/state")
    return found.groupBy("room").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events),
l AS (SELECT *, min(CASE WHEN event_type NOT IN ('click', 'error') THEN back END) OVER (PARTITION BY user_id) AS ask FROM b WHERE back <= 6)
SELECT user_id, event_id, CASE WHEN back = ask THEN 'reply' WHEN event_type = 'click' THEN 'bot' ELSE 'user' END AS slot FROM l WHERE event_type <> 'error'""")
def seed_messages(spark, folder):
    """The last six events of every user as a bridge starts with them; clicks stand for the bot, errors for an ignored speaker."""
    rows = rooms.seeds(table(spark, folder, "events"), "user_id", "event_id", "event_type", last=6, ignore=("error",), bot="click")
    return rows.select("user_id", "event_id", "slot")


@query("""WITH r AS (SELECT source, 'run' || (doc_id % 9) || CASE WHEN doc_id % 2 = 0 THEN '_cpt' ELSE '' END AS run, doc_id AS modified, CASE WHEN doc_id % 5 > 0 THEN 'adapter' || doc_id END AS adapter FROM documents),
k AS (SELECT *, 'run' || (length(source) % 12) AS wanted FROM r WHERE adapter IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN run = wanted THEN 2 WHEN run = wanted || '_cpt' THEN 1 ELSE 0 END DESC, modified DESC) AS k FROM k)
SELECT source, run, adapter FROM n WHERE k = 1""")
def run_to_serve(spark, folder):
    """The run that each source would be served by: the wanted one, its first stage, or the newest."""
    end = F.when(F.col("doc_id") % 2 == 0, "_cpt").otherwise("")
    runs = table(spark, folder, "documents").select(
        "source", F.concat(F.lit("run"), F.col("doc_id") % 9, end).alias("run"), F.col("doc_id").alias("modified"),
        F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("adapter"), "doc_id")).alias("adapter"),
    )
    return rooms.run_to_serve(runs, "source", F.concat(F.lit("run"), F.length("source") % 12))


@query("SELECT conv_id, turn, ['yes', 'no', 'later'][1 + CAST('0x' || substr(sha256(coalesce(text, '')), 1, 8) AS BIGINT) % 3] AS reply FROM conversations")
def fallback_texts(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", replies.fallback_text("text", ("yes", "no", "later")).alias("reply"))
