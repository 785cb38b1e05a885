"""More queries of the engine: replies, vocabulary, rooms and datasets; added to the registry by import."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions import replies as R
from palaver.functions import text as T
from palaver.operators import dialogue, messages, rooms, tokens
from palaver.operators.vocabulary import Vocabulary, aligned, mask_of
from palaver.plans.registry import CV, LN, cv, ev, ln, one_line_sql, query, strip_sql, table
from palaver.sources import chat, datasets
from palaver.streaming import dedup as streams

VOCABULARY = Vocabulary({"assistant": "<|spk:assistant|>", "user": "<|spk:user|>"})


def _cut_sql(out: str, source: str) -> str:
    """The steps of `strip_artifacts` as a chain of tables, the last one named `out`."""
    last = f"split_part({strip_sql('t')}, '[ANSWER]', len(string_split({strip_sql('t')}, '[ANSWER]')))"
    steps = [f"s0 AS (SELECT conv_id, turn, {strip_sql(last)} AS t FROM {source})"]
    for k, m in enumerate((*R.SECTIONS, *R.ROLES)):
        at = f"position('{m}' IN lower(t))" if m in R.ROLES else f"position('{m}' IN t)"
        head = f"WHEN {at} = 1 THEN {strip_sql(f'substring(t, {len(m) + 1})')} " if m in R.SECTIONS else ""
        steps.append(f"s{k + 1} AS (SELECT conv_id, turn, CASE {head}WHEN {at} > 1 THEN {strip_sql(f'substring(t, 1, {at} - 1)')} ELSE t END AS t FROM s{k})")
    steps.append(f"{out} AS (SELECT conv_id, turn, regexp_replace(t, '^(?i)((답변:|출력:|assistant:|bot:|AI:)\\s*)+', '') AS t FROM s{len(R.SECTIONS) + len(R.ROLES)})")
    return ", ".join(steps)


@query(f"WITH src AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '[TASK] a [ANSWER] ' || text WHEN 1 THEN ' bot: AI: ' || text || ' [SYSTEM] z' WHEN 2 THEN text || ' User: q' ELSE text END AS t FROM conversations), {_cut_sql('r', 'src')} SELECT conv_id, turn, t AS reply FROM r")
def strip_artifacts(spark, folder):
    shape = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("[TASK] a [ANSWER] "), "text")).when(F.col("turn") % 4 == 1, F.concat(F.lit(" bot: AI: "), "text", F.lit(" [SYSTEM] z"))).when(F.col("turn") % 4 == 2, F.concat("text", F.lit(" User: q"))).otherwise(F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", R.strip_artifacts(shape).alias("reply"))


TAG = r"^\s*(\[[^\]\n]{1,24}\]|[@A-Za-z0-9_.\-가-힣]{1,24})\s*:\s*"


@query(f"SELECT conv_id, turn, {strip_sql(f'''regexp_replace(regexp_replace(regexp_replace({one_line_sql("role || ': [' || role || '] : ' || text")}, '{TAG}', ''), '{TAG}', ''), '{TAG}', '')''')} AS reply FROM conversations")
def normalize_reply(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", R.normalize_reply(F.concat("role", F.lit(": ["), "role", F.lit("] : "), "text")).alias("reply"))


def _slug_sql(keep: str, ends: str, empty: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(regexp_replace({strip_sql('url')}, '[^{keep}]+', '_', 'g'), '_+', '_', 'g'), '{ends}'), ''), '{empty}')"


@query(f"SELECT page_id, {_slug_sql(r'\p{L}\p{N}_.\-', '_.', 'unknown')} AS file_slug, {_slug_sql(r'A-Za-z0-9_.\-', '_.-', 'archive')} AS tag_slug FROM pages")
def slugs(spark, folder):
    return table(spark, folder, "pages").select("page_id", R.file_slug("url").alias("file_slug"), R.tag_slug("url").alias("tag_slug"))


@query("SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'bot' ELSE 'user' END AS role, role || ': ' || text AS line FROM conversations")
def roles(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", R.role("role").alias("role"), R.user_turn("role", "text").alias("line"))


@query()
def self_echo(spark, folder):
    """Bot turns against the bot's turn before, with the ratio of matching blocks."""
    bots = table(spark, folder, "conversations").where("role = 'assistant'")
    last = F.lag("text").over(messages.Window.partitionBy("conv_id").orderBy("turn"))
    return bots.withColumn("last", last).select("conv_id", "turn", R.echoes("text", F.col("last")).alias("echo"))


@query()
def reply_scores(spark, folder):
    bots = table(spark, folder, "conversations").where("role = 'assistant'")
    last = F.lag("text").over(messages.Window.partitionBy("conv_id").orderBy("turn"))
    return dialogue.scored(bots.withColumn("last", last), "text", "last").select("conv_id", "turn", "score", "reply")


@query("SELECT conv_id, turn, strlen(text) + 3 AS n_ids, '<|bos|>' || text || '<|eos|>' || chr(10) AS decoded FROM conversations")
def encode_decode(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", VOCABULARY.encode(F.concat(F.lit("<|bos|>"), "text", F.lit("<|eos|>\n"))).alias("ids"))
    return rows.select("conv_id", "turn", F.size("ids").cast("bigint").alias("n_ids"), VOCABULARY.decode(F.col("ids")).alias("decoded"))


@query("SELECT conv_id, turn, strlen(text) + 4 AS n_ids, strlen(text) + 2 AS n_loss FROM conversations")
def masked_rows(spark, folder):
    """Turns as ids with their loss mask, of one length."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", VOCABULARY.encode(VOCABULARY.row("role", "text")).alias("ids"), mask_of(F.lit(2), tokens.row_counts("text")[1]).alias("mask"))
    ids = aligned(F.col("ids"), F.col("mask"))
    return rows.select("conv_id", "turn", F.size(ids).cast("bigint").alias("n_ids"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_loss"))


@query("SELECT conv_id, string_agg('<|bos|><|spk:' || CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'UNKNOWN' END || '|>' || text || '<|eos|>' || chr(10), '' ORDER BY turn) || '<|bos|><|spk:assistant|>' AS prompt, 2 + 1 AS stops FROM conversations GROUP BY 1")
def turn_prompts(spark, folder):
    packed = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("speaker"), "text"))).alias("turns"))
    stops = F.size(VOCABULARY.stop_ids(F.lit("assistant")))
    return packed.select("conv_id", VOCABULARY.prompt("turns", F.lit("assistant")).alias("prompt"), stops.cast("int").alias("stops"))


@query(f"WITH {LN}, x AS (SELECT doc_id, line_no, {strip_sql('text')} AS line, text FROM ln) SELECT CAST(doc_id AS VARCHAR) AS source_file, coalesce(arg_min(line, line_no) FILTER (line <> ''), CAST(doc_id AS VARCHAR)) AS room, 'unknown' AS saved_at, count(*) - CASE WHEN arg_max(text, line_no) = '' THEN 1 ELSE 0 END AS line_count FROM x GROUP BY 1")
def room_metadata(spark, folder):
    """Documents as chat files whose first line is their title."""
    title = F.concat(F.regexp_replace("text", rf"^({T.WS}*)([^\n]*)", "$1$2 카카오톡 대화"))
    texts = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("source_file"), F.when(T.strip(F.col("text")) == "", F.col("text")).otherwise(title).alias("text"))
    return rooms.metadata(texts).select("source_file", "room", "saved_at", "line_count")


@query(f"WITH {CV}, r AS (SELECT source_file, seq, speaker, {strip_sql('split_part(text, chr(10), 1)')} AS text FROM cv WHERE speaker <> 'assistant' AND {strip_sql('split_part(text, chr(10), 1)')} <> '') SELECT source_file, arg_max(speaker, seq) AS speaker, arg_max(text, seq) AS text FROM r GROUP BY 1")
def last_messages(spark, folder):
    """The last line that is a message: of a message of many lines, its first."""
    rows = cv(spark, folder)
    line = F.concat(F.lit("2024. 1. 1. 9:"), F.lpad((F.col("seq") % 60).cast("string"), 2, "0"), F.lit(", "), "speaker", F.lit(" : "), "text")
    packed = rows.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    return rooms.last_message(packed, ignore="assistant").select("source_file", "speaker", "text")


@query(f"WITH {CV} SELECT source_file, count(*) FILTER (turn > 2) AS messages, CASE WHEN count(*) FILTER (turn > 2) > 0 THEN 'used' ELSE 'no_chat_messages' END AS state FROM cv GROUP BY 1")
def file_books(spark, folder):
    rows = cv(spark, folder)
    return rooms.file_book(rows, rows.where("turn > 2"))


@query("SELECT arg_min(path, doc_id) AS path, min(doc_id) AS doc_id FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN upper(source || '/' || lang) ELSE source || '/' || lang END AS path FROM documents) GROUP BY lower(path)")
def path_dedup(spark, folder):
    path = F.concat("source", F.lit("/"), "lang")
    return rooms.distinct_paths(table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.upper(path)).otherwise(path).alias("path")), "path", "doc_id")


@query("SELECT room, event_id FROM (SELECT *, lag(event_type) OVER (PARTITION BY room ORDER BY event_id) AS last FROM (SELECT user_id % 8 AS room, event_id, event_type FROM events)) WHERE event_type IS DISTINCT FROM last")
def snapshot_skip(spark, folder):
    return rooms.changed(table(spark, folder, "events").select((F.col("user_id") % 8).alias("room"), "event_id", "event_type"), "room", "event_id", "event_type").select("room", "event_id")


@query("SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2 THEN 'reply' ELSE 'context' END AS slot FROM conversations")
def reply_slots(spark, folder):
    return rooms.reply_slots(table(spark, folder, "conversations"), "conv_id", "turn", 2).select("conv_id", "turn", "slot")


@query("SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations WHERE role <> 'assistant' GROUP BY 1")
def start_targets(spark, folder):
    return rooms.start_target(table(spark, folder, "conversations"))


@query("""WITH f AS (SELECT 'run_' || (user_id % 8) AS run, CASE WHEN event_id % 97 = 0 THEN 'best' ELSE 'checkpoint-' || (event_id // 40) END AS dir,
  CASE event_type WHEN 'error' THEN 'trainer_state.json' WHEN 'view' THEN 'adapter_config.json' WHEN 'click' THEN 'adapter_model.safetensors' WHEN 'purchase' THEN 'adapter_model.bin' ELSE 'rng.pth' END AS file FROM events),
g AS (SELECT run, dir, CAST(substr(dir, 12) AS BIGINT) AS step FROM f WHERE starts_with(dir, 'checkpoint-') GROUP BY 1, 2
  HAVING bool_or(file = 'trainer_state.json') AND bool_or(file = 'adapter_config.json') AND bool_or(starts_with(file, 'adapter_model.')))
SELECT run, arg_max(dir, step) AS dir, max(step) AS step FROM g GROUP BY 1""")
def latest_checkpoint(spark, folder):
    """Events as the files of runs' checkpoints: which ones a folder has is what happened in it."""
    kind = {"error": rooms.STATE, "view": rooms.ADAPTER, "click": rooms.WEIGHTS[0], "purchase": rooms.WEIGHTS[1]}
    file = F.coalesce(*(F.when(F.col("event_type") == k, v) for k, v in kind.items()), F.lit("rng.pth"))
    step = F.floor(F.col("event_id") / 40).cast("string")
    folder_of = F.when(F.col("event_id") % 97 == 0, "best").otherwise(F.concat(F.lit("checkpoint-"), step))
    files = table(spark, folder, "events").select(F.concat(F.lit("run_"), F.col("user_id") % 8).alias("run"), folder_of.alias("dir"), file.alias("file"))
    return rooms.latest(rooms.checkpoints(files), ["run"], "dir", "step")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS k FROM documents) WHERE k > 3")
def retention(spark, folder):
    return rooms.expired(table(spark, folder, "documents").select("source", "doc_id"), ["source"], "doc_id", 3)


@query(f"WITH {CV}, r AS (SELECT conv_id, seq, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY seq) AS pos FROM cv) SELECT conv_id, seq, CASE WHEN n < 4 OR pos <= least(greatest(floor(n * CAST(0.5 AS DOUBLE)), 2), n - 2) THEN 'train' ELSE 'val' END AS split FROM r")
def single_split(spark, folder):
    return messages.single_split(cv(spark, folder), ["conv_id"], 0.5).select("conv_id", "seq", "split")


@query()
def shuffled_split(spark, folder):
    return messages.shuffled_split(messages.sessions(ev(spark, folder)))


@query()
def fallback_rate(spark, folder):
    rows = table(spark, folder, "events").select((F.col("user_id") % 8).alias("room"), F.col("event_id").alias("seq"), (F.pmod(F.xxhash64("event_id"), F.lit(100)) / 100).alias("confidence"))
    return streams.fallback_rate(rows, "room")


@query("SELECT conv_id, turn, role, text FROM conversations")
def lines_roundtrip(spark, folder):
    """Conversations written as JSON lines and read back."""
    path, rows = f"{streams.folder(spark, 'lines')}/rows", table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    datasets.write_lines(rows, path, ["conv_id", "turn"])
    return datasets.read_lines(spark, path, rows.schema)
