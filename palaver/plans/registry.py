"""All queries of the engine and their SQL: `QUERIES` and `ORACLE`, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.operators import dialogue, manifest, messages, tokens
from palaver.sources import chat
from palaver.streaming import dedup as streams

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
SYSTEM, TASK = "You are a friend in this chat.", "Answer the last line."
# RE2 form of the shared white space
W = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cv(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as messages; a turn a minute."""
    return table(spark, folder, "conversations").select(F.concat(F.lit("conv_"), "conv_id").alias("source_file"), F.col("turn").alias("seq"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.col("role").alias("speaker"), "text", "conv_id", "turn", "role")


def ev(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages of eight rooms, in whole minutes."""
    return table(spark, folder, "events").select(F.concat(F.lit("room_"), F.col("user_id") % 8).alias("source_file"), F.col("event_id").alias("seq"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("speaker"), F.concat_ws(" ", "event_type", "props").alias("text"))


def ln(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as lines."""
    return table(spark, folder, "documents").select("doc_id", F.col("source").alias("source_file"), F.col("lang").alias("speaker"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")).withColumn("seq", F.col("doc_id") * 1_000_000 + F.col("line_no"))


CV = "cv AS (SELECT 'conv_' || conv_id AS source_file, turn AS seq, role AS speaker, text, conv_id, turn, role FROM conversations)"
EV = "ev AS (SELECT 'room_' || (user_id % 8) AS source_file, event_id AS seq, date_trunc('minute', ts) AS ts, event_type AS speaker, concat_ws(' ', event_type, props) AS text FROM events)"
LN = "parts AS (SELECT doc_id, source AS source_file, lang AS speaker, string_split(text, chr(10)) AS p FROM documents), ln AS (SELECT doc_id, source_file, speaker, i AS line_no, p[i + 1] AS text, doc_id * 1000000 + i AS seq FROM parts, unnest(range(len(p))) AS u(i))"


def strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{W}+', ''), '{W}+$', '')"


def clean_sql(x: str) -> str:
    body = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({strip_sql(body)}, '\\x{{200b}}+', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"


def one_line_sql(x: str) -> str:
    return strip_sql(f"regexp_replace(regexp_replace({x}, '{W}*\\n+{W}*', ' ', 'g'), '[ \\t]{{2,}}', ' ', 'g')")


def compact_sql(x: str) -> str:
    return f"regexp_replace({x}, '{W}', '', 'g')"


LOW = r"(c = '' OR upper(c) = '<URL>' OR (length(c) <= 8 AND regexp_full_match(c, '[ㅋㅎㅠㅜ]+')) OR (length(c) <= 10 AND regexp_full_match(c, '[\s~!?.…·,:;''\"()\[\]{}<>/\\\-_=+*^|`]+')) OR c IN ('ㅇㅇ', 'ㄱㄱ', 'ㄴㄴ', 'ok', 'OK'))"
BULLETS = rf"len(regexp_extract_all(t, '(?m)^{W}*[·•\-]{W}+'))"


@query(f"WITH {CV} SELECT source_file, seq, speaker, text FROM cv")
def ingest_messages(spark, folder):
    return cv(spark, folder).select("source_file", "seq", "speaker", "text")


@query(f"WITH {CV} SELECT source_file, seq, speaker, {strip_sql('text')} AS text FROM cv WHERE {strip_sql('text')} <> ''")
def parse_roundtrip(spark, folder):
    """Conversations rendered as a chat export and parsed again."""
    row = cv(spark, folder)
    line = F.concat(F.lit("2024. 1. 1. 9:"), F.lpad((F.col("seq") % 60).cast("string"), 2, "0"), F.lit(", "), "speaker", F.lit(" : "), "text")
    packed = row.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    parsed = chat.messages(packed)
    order = F.row_number().over(messages.Window.partitionBy("source_file").orderBy("seq")) - 1
    return parsed.select("source_file", order.cast("bigint").alias("seq"), "speaker", "text")


@query("SELECT source, sha256(string_agg(text, chr(10) ORDER BY doc_id)) AS sha256, strlen(string_agg(text, chr(10) ORDER BY doc_id)) AS bytes, len(string_split(string_agg(text, chr(10) ORDER BY doc_id), chr(10))) AS line_count FROM documents GROUP BY source")
def file_inventory(spark, folder):
    return manifest.inventory(table(spark, folder, "documents"), "source", "text", "doc_id")


@query(f"SELECT doc_id, regexp_replace({clean_sql('text')}, 'https?://\\S+', '<URL>', 'g') AS clean FROM documents")
def clean_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.clean_message("text").alias("clean"))


@query("SELECT page_id, regexp_replace(url, 'https?://\\S+', '<URL>', 'g') AS masked FROM pages")
def mask_urls(spark, folder):
    return table(spark, folder, "pages").select("page_id", T.mask_urls("url").alias("masked"))


@query("SELECT doc_id, sha256(regexp_replace(text, '\\b\\d{3,}\\b', '<NUM>', 'g')) AS masked FROM documents")
def mask_numbers(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.mask_numbers("text"), 256).alias("masked"))


DROPS = f"""WITH {LN}, a AS (SELECT doc_id, line_no, regexp_replace({clean_sql('text')}, 'https?://\\S+', '<URL>', 'g') AS full_text FROM ln),
b AS (SELECT *, CASE WHEN length(full_text) > 320 THEN regexp_replace(substring(full_text, 1, 320), '{W}+$', '') ELSE full_text END AS t FROM a),
k AS (SELECT *, {compact_sql('t')} AS c FROM b),
r AS (SELECT doc_id, line_no, t, CASE WHEN full_text = '' THEN 'empty_after_clean' WHEN length(c) < 8 THEN 'short_message' WHEN {LOW} THEN 'low_signal' WHEN {BULLETS} >= 1 THEN 'summary_artifact'
WHEN len(regexp_extract_all(t, '@[A-Za-z0-9_.\\-가-힣]+')) > 2 THEN 'mention_artifact' END AS reason FROM k)"""


@query(f"{DROPS} SELECT doc_id, line_no, t AS text, reason FROM r")
def drop_cascade(spark, folder):
    return messages.cascade(ln(spark, folder), shortest=8).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "text", "reason")


@query(f"{DROPS} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1")
def drop_reasons(spark, folder):
    return drop_cascade(spark, folder).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, len(regexp_extract_all(text, '@[A-Za-z0-9_.\\-가-힣]+')) AS mentions FROM documents")
def mention_counts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.count_mentions("text").cast("bigint").alias("mentions"))


@query(f"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '@[A-Za-z0-9_.\\-가-힣]+', '', 'g'), '[ \\t]{{2,}}', ' ', 'g'), '{W}*([,;:]){W}*', '\\1 ', 'g'), ' ' || chr(9) || ',;:') AS clean FROM documents")
def strip_mentions(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.strip_mentions("text").alias("clean"))


@query()
def trim_mentions(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.trim_mentions("text", 1).alias("clean"))


@query(f"SELECT doc_id, length({compact_sql('text')}) AS n FROM documents")
def compact_length(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.compact_length("text").cast("bigint").alias("n"))


@query(f"SELECT doc_id, {one_line_sql('text')} AS line FROM documents")
def one_line(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.one_line("text").alias("line"))


#: Tabs and vertical tabs for the blanks of one third of the documents, a leading line end and deletes in another.
ODD_SQL = "CASE doc_id % 3 WHEN 0 THEN replace(text, ' ', chr(9) || chr(9) || chr(11)) WHEN 1 THEN chr(10) || replace(text, ' ', chr(127) || ' ') ELSE text END"
NO_CONTROL_SQL = f"regexp_replace(replace(replace(regexp_replace({ODD_SQL}, '\\r\\n?', chr(10), 'g'), chr(160), ' '), chr(8203), ''), '[\\x00-\\x08\\x0b-\\x1f\\x7f]', '', 'g')"
SANITIZED_SQL = f"SELECT doc_id, {one_line_sql(NO_CONTROL_SQL)} AS x FROM documents"


@query(f"SELECT doc_id, CASE WHEN length(x) > 200 THEN regexp_replace(substring(x, 1, 200), '{W}+$', '') ELSE x END AS line FROM ({SANITIZED_SQL})")
def sanitize(spark, folder):
    kind = F.col("doc_id") % 3
    odd = F.when(kind == 0, F.replace("text", F.lit(" "), F.lit("\t\t\x0b"))).when(kind == 1, F.concat(F.lit("\n"), F.replace("text", F.lit(" "), F.lit("\x7f ")))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", T.sanitize_text(odd, 200).alias("line"))


@query(f"WITH {LN}, k AS (SELECT doc_id, line_no, {compact_sql('text')} AS c FROM ln UNION ALL SELECT -1, i, c FROM (VALUES (0, ''), (1, 'ㅋㅋㅋ'), (2, '?!'), (3, 'ㅇㅇ'), (4, '<url>'), (5, 'okay')) v(i, c)) SELECT doc_id, line_no, {LOW} AS low FROM k")
def low_signal(spark, folder):
    more = spark.createDataFrame([(-1, 0, ""), (-1, 1, "ㅋㅋㅋ"), (-1, 2, "?!"), (-1, 3, "ㅇㅇ"), (-1, 4, "<url>"), (-1, 5, "okay")], "doc_id bigint, line_no bigint, text string")
    return ln(spark, folder).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "text").union(more).select("doc_id", "line_no", T.is_low_signal("text").alias("low"))


@query(f"WITH {LN} SELECT source_file, speaker, text, min(seq) AS seq FROM ln GROUP BY 1, 2, 3")
def exact_dedup(spark, folder):
    return messages.dedup(ln(spark, folder), ["source_file", "speaker", "text"]).select("source_file", "speaker", "text", "seq")


MERGED = f"""WITH RECURSIVE {EV}, o AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY ts, seq) AS n FROM ev),
m AS (SELECT source_file, n, speaker, ts, seq, text, 1 AS block FROM o WHERE n = 1 UNION ALL
SELECT o.source_file, o.n, o.speaker, o.ts, CASE WHEN j THEN m.seq ELSE o.seq END, CASE WHEN j THEN m.text || chr(10) || o.text ELSE o.text END, CASE WHEN j THEN m.block ELSE m.block + 1 END
FROM m JOIN (SELECT * FROM o) o ON o.source_file = m.source_file AND o.n = m.n + 1, LATERAL (SELECT o.speaker = m.speaker AND epoch(o.ts) - epoch(m.ts) BETWEEN 0 AND 120 AND length(m.text) + length(o.text) + 1 <= 320 AS j)),
merged AS (SELECT source_file, arg_max(seq, n) AS seq, max(ts) AS ts, arg_max(speaker, n) AS speaker, arg_max(text, n) AS text FROM m GROUP BY source_file, block)"""


@query(f"{MERGED} SELECT * FROM merged")
def merge_messages(spark, folder):
    return messages.merge(ev(spark, folder))


SESSIONS = f"""WITH {EV}, g AS (SELECT *, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY source_file ORDER BY ts, seq)) > 180 * 60 THEN 1 ELSE 0 END AS new FROM ev),
s AS (SELECT source_file, seq, ts, speaker, text, CAST(sum(new) OVER (PARTITION BY source_file ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_index FROM g)"""


@query(f"{SESSIONS} SELECT source_file, seq, session_index FROM s")
def sessions(spark, folder):
    return messages.sessions(ev(spark, folder)).select("source_file", "seq", "session_index")


@query(f"{SESSIONS} SELECT source_file, session_index, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, count(DISTINCT speaker) AS speakers FROM s GROUP BY 1, 2")
def session_stats(spark, folder):
    return messages.sessions(ev(spark, folder)).groupBy("source_file", "session_index").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n"), F.count_distinct("speaker").alias("speakers"))


@query(f"{SESSIONS}, e AS (SELECT source_file, session_index, min(ts) AS start_ts, count(*) AS n_messages FROM s GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (ORDER BY start_ts, source_file, session_index) AS k, count(*) OVER () AS n FROM e) SELECT source_file, session_index, start_ts, n_messages, CASE WHEN k <= least(greatest(floor(n * CAST(0.98 AS DOUBLE)), 1), n - 1) THEN 'train' ELSE 'val' END AS split FROM r")
def split_train_val(spark, folder):
    return messages.session_split(messages.sessions(ev(spark, folder)))


CONTEXT = f"""WITH {CV}, l AS (SELECT conv_id, seq, speaker, {one_line_sql('text')} AS line FROM cv), c AS (SELECT conv_id, seq, line AS response, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS n, coalesce(list(speaker || ': ' || line) OVER (PARTITION BY conv_id ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []) AS ctx FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY seq)),
x AS (SELECT *, CASE WHEN n < 2 THEN 'short_session' WHEN length({compact_sql('response')}) < 2 THEN 'short_target' WHEN len(ctx) < 2 THEN 'short_context' END AS reason FROM c WHERE pos >= 1 OR n < 2)"""


def _contexts(spark, folder):
    return messages.contexts(cv(spark, folder), ["conv_id"])


@query(f"{CONTEXT} SELECT conv_id, pos, '[SYSTEM]' || chr(10) || '{SYSTEM}' || chr(10) || chr(10) || '[TASK]' || chr(10) || '{TASK}' || chr(10) || chr(10) || '[DIALOGUE]' || chr(10) || array_to_string(ctx, chr(10)) || chr(10) || chr(10) || '[ANSWER]' || chr(10) AS prompt, response, len(ctx) AS context_turns FROM x WHERE reason IS NULL")
def sft_examples(spark, folder):
    rows = _contexts(spark, folder).where("reason is null")
    return rows.select("conv_id", F.col("pos").cast("bigint").alias("pos"), T.prompt(F.col("context"), SYSTEM, TASK).alias("prompt"), "response", F.size("context").cast("bigint").alias("context_turns"))


@query(f"{CONTEXT} SELECT len(ctx) AS context_turns, count(*) AS n FROM x WHERE reason IS NULL GROUP BY 1")
def sft_context_counts(spark, folder):
    return sft_examples(spark, folder).groupBy("context_turns").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CONTEXT} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM x GROUP BY 1")
def sft_drop_counts(spark, folder):
    return _contexts(spark, folder).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{CONTEXT} SELECT conv_id, pos FROM x WHERE reason IS NULL ORDER BY conv_id, pos LIMIT 50")
def example_cap(spark, folder):
    return messages.capped(sft_examples(spark, folder).select("conv_id", "pos"), ["conv_id", "pos"], 50)


@query(f"{CONTEXT} SELECT conv_id, pos, response FROM x WHERE reason IS NULL ORDER BY conv_id, pos LIMIT 3")
def preview_topk(spark, folder):
    return sft_examples(spark, folder).select("conv_id", "pos", "response").orderBy("conv_id", "pos").limit(3)


@query(f"{CONTEXT} SELECT coalesce(round(avg(len(ctx)), 3), 0) AS avg_turns FROM x WHERE reason IS NULL")
def avg_context(spark, folder):
    return sft_examples(spark, folder).agg(F.coalesce(F.round(F.avg("context_turns"), 3), F.lit(0.0)).alias("avg_turns"))


@query(f"""{SESSIONS}, p AS (SELECT source_file, session_index, list(speaker || ': ' || {one_line_sql('text')} ORDER BY ts, seq) AS a FROM s GROUP BY 1, 2 HAVING count(*) >= 4),
k AS (SELECT source_file, session_index, i AS start, list_slice(a, i + 1, i + 8) AS part FROM p, unnest(range(0, len(a), 4)) AS u(i)),
t AS (SELECT source_file, session_index, start, len(part) AS message_count, {strip_sql('array_to_string(part, chr(10))')} AS x FROM k WHERE len(part) >= 4),
c AS (SELECT source_file, session_index, start, message_count, CASE WHEN length(x) > 600 THEN regexp_replace(substring(x, 1, 600), '{W}+$', '') ELSE x END AS text FROM t) SELECT *, CASE WHEN length({compact_sql('text')}) < 60 THEN 'short_chunk' END AS reason FROM c""")
def cpt_chunks(spark, folder):
    rows = messages.chunks(messages.sessions(ev(spark, folder)), ["source_file", "session_index"], window=8, stride=4, least=4, shortest=60, longest=600)
    return rows.withColumns({"start": F.col("start").cast("bigint"), "message_count": F.col("message_count").cast("bigint")})


@query(f"WITH {EV} SELECT speaker, count(*) AS n FROM ev GROUP BY 1")
def speaker_counts(spark, folder):
    return ev(spark, folder).groupBy("speaker").agg(F.count(F.lit(1)).alias("n"))


@query(f"{MERGED} SELECT (SELECT count(*) FROM ev) AS parsed, (SELECT count(*) FROM merged) AS merged, (SELECT count(*) FROM ev) - (SELECT count(*) FROM merged) AS merged_into_previous")
def stage_counts(spark, folder):
    rows = ev(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("parsed")).join(messages.merge(rows).agg(F.count(F.lit(1)).alias("merged")), how="full", on=F.lit(True)).withColumn("merged_into_previous", F.col("parsed") - F.col("merged"))


@query("WITH p AS (SELECT *, row_number() OVER w AS pos FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), g AS (SELECT *, pos - max(CASE WHEN role = 'assistant' THEN pos END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS since, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS recent FROM p) SELECT conv_id, turn, role <> 'assistant' AND coalesce(since >= 4, true) AND recent < 2 AS reply FROM g")
def reply_gate(spark, folder):
    return dialogue.reply_gate(table(spark, folder, "conversations")).select("conv_id", "turn", "reply")


@query("WITH b AS (SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS bots FROM conversations), k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM b WHERE role <> 'assistant' OR bots <= 2) SELECT conv_id, turn, role FROM k WHERE n <= 4")
def history_select(spark, folder):
    return dialogue.history(table(spark, folder, "conversations"), last=4).select("conv_id", "turn", "role")


@query("SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n <= 3")
def last_n_history(spark, folder):
    return dialogue.history(table(spark, folder, "conversations"), last=3, bots=1 << 30).select("conv_id", "turn")


@query("""WITH r AS (SELECT conv_id, turn, strlen(text) + 3 AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations), l AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, sum(k) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS suffix FROM r WHERE back <= 8),
f AS (SELECT *, coalesce(max(CASE WHEN (n - back) % 2 = 0 AND (suffix <= 600 OR back <= 1) THEN back END) OVER (PARTITION BY conv_id), 0) AS keep FROM l) SELECT conv_id, turn FROM f WHERE back <= keep""")
def history_token_trim(spark, folder):
    return dialogue.token_trim(table(spark, folder, "conversations"), F.octet_length("text") + 3, budget=600).select("conv_id", "turn")


@query("WITH b AS (SELECT conv_id, turn, regexp_replace(lower(text), '[^A-Za-z0-9가-힣]+', '', 'g') AS own FROM conversations WHERE role = 'assistant'), l AS (SELECT *, lag(own) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM b) SELECT conv_id, turn, coalesce(length(own) >= 8 AND length(prev) >= 8 AND (own = prev OR (length(own) >= 12 AND (contains(prev, own) OR contains(own, prev)))), false) AS echo FROM l")
def self_echo_native(spark, folder):
    return dialogue.self_echo(table(spark, folder, "conversations")).select("conv_id", "turn", "echo")


WORDS = f"list_filter(regexp_split_to_array(text, '{W}+'), lambda x: x <> '')"


@query(f"SELECT doc_id, len(w) AS n, len(list_distinct(w)) AS n_distinct, len(list_distinct(w)) / greatest(len(w), 1) < CAST(0.55 AS DOUBLE) AND len(w) >= 10 AS few FROM (SELECT doc_id, {WORDS} AS w FROM documents)")
def token_uniqueness(spark, folder):
    w = T.words("text")
    return table(spark, folder, "documents").select("doc_id", F.size(w).cast("bigint").alias("n"), F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"), ((F.size(w) >= 10) & (T.distinct_ratio(w) < F.lit(0.55))).alias("few"))


@query(f"WITH w AS (SELECT conv_id, turn, {WORDS} AS w FROM conversations), g AS (SELECT conv_id, turn, w[i] || chr(31) || w[i + 1] AS g FROM w, unnest(range(1, len(w))) AS u(i)), c AS (SELECT conv_id, turn, g, count(*) AS n FROM g GROUP BY 1, 2, 3) SELECT conv_id, turn, coalesce(max(n), 0) AS top FROM w LEFT JOIN c USING (conv_id, turn) GROUP BY 1, 2")
def ngram_top(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", T.top_ngram(T.words("text"), 2).cast("bigint").alias("top"))


@query(f"WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents) SELECT doc_id, coalesce(array_to_string(list_filter(w, lambda x, i: i <= 2 OR NOT (x = w[i - 1] AND x = w[i - 2])), ' '), '') AS text FROM w")
def run_cap(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.array_join(T.run_capped(T.words("text")), " ").alias("text"))


@query()
def repetition_backref(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", T.is_repetitive("text").alias("repetitive"), T.soften_repetition("text").alias("softened"))


SCORES = f"WITH s AS (SELECT conv_id, turn, CASE WHEN length(replace(text, ' ', '')) < 2 THEN 60 ELSE 100 END - CASE WHEN regexp_matches(text, '(?i)(요약|정리|핵심|summary)') AND length({strip_sql('text')}) >= 20 THEN 25 ELSE 0 END AS score FROM conversations WHERE role = 'assistant')"


@query(f"{SCORES} SELECT conv_id, turn, score FROM s")
def candidate_score(spark, folder):
    return table(spark, folder, "conversations").where("role = 'assistant'").select("conv_id", "turn", dialogue.score("text").alias("score"))


@query(f"{SCORES}, b AS (SELECT conv_id, turn AS trial, score, max(score) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, trial) AS n FROM b WHERE coalesce(before, 0) < 100) SELECT conv_id, trial, score FROM r WHERE n = 1")
def best_candidate(spark, folder):
    return dialogue.best(candidate_score(spark, folder).withColumnRenamed("turn", "trial"), ["conv_id"])


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: -abs(CAST(x AS DOUBLE)))) / len(embedding), 6) AS logprob, round(least(1.0, greatest(0.0, exp(list_sum(list_transform(embedding, lambda x: -abs(CAST(x AS DOUBLE)))) / len(embedding)))), 6) AS confidence FROM embeddings")
def confidence(spark, folder):
    mean, conf = dialogue.confidence(F.transform("embedding", lambda x: -F.abs(x.cast("double"))))
    return table(spark, folder, "embeddings").select("vec_id", F.round(mean, 6).alias("logprob"), F.round(conf, 6).alias("confidence"))


@query(f"WITH {EV} SELECT source_file, seq, sha1(concat_ws('|', strftime(ts, '%Y-%m-%d'), strftime(ts, '%H:%M'), {strip_sql(f"regexp_replace(speaker, '{W}+', ' ', 'g')")}, {strip_sql(f"regexp_replace(text, '{W}+', ' ', 'g')")})) AS uid FROM ev")
def message_uid(spark, folder):
    return ev(spark, folder).select("source_file", "seq", T.message_uid(F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm"), F.col("speaker"), F.col("text")).alias("uid"))


@query(f"WITH {EV} SELECT source_file, seq, strftime(ts, '%H:%M') AS hm FROM ev")
def to_24h(spark, folder):
    hour = F.hour("ts")
    half = F.when(hour < 12, "오전").otherwise("오후")
    time = F.concat(F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string"), F.lit(":"), F.date_format("ts", "mm"))
    return ev(spark, folder).select("source_file", "seq", T.to_24h(half, time).alias("hm"))


@query(f"WITH {EV} SELECT DISTINCT speaker, '<|spk:' || regexp_replace(speaker, '{W}+', '_', 'g') || '|>' AS token FROM ev")
def speaker_tokens(spark, folder):
    return tokens.speaker_tokens(ev(spark, folder))


@query("SELECT conv_id, turn, 2 AS prefix, strlen(text) + 2 AS target FROM conversations")
def token_counts(spark, folder):
    a, b = tokens.row_counts("text")
    return table(spark, folder, "conversations").select("conv_id", "turn", a.alias("prefix"), b.cast("bigint").alias("target"))


@query("SELECT sum(strlen(text) + 4) AS tokens, sum(strlen(text) + 2) AS loss_tokens, round(sum(strlen(text) + 2) / greatest(1, sum(strlen(text) + 4)), 6) AS ratio FROM conversations")
def loss_ratio(spark, folder):
    rows = token_counts(spark, folder).agg(F.sum(F.col("prefix") + F.col("target")).alias("tokens"), F.sum("target").alias("loss_tokens"))
    return rows.withColumn("ratio", F.round(F.col("loss_tokens") / F.greatest(F.lit(1), F.col("tokens")), 6))


def _sft_tokens(spark, folder):
    rows = sft_examples(spark, folder).select("conv_id", "pos", tokens.byte_ids("prompt", 4).alias("p"), tokens.byte_ids("response", 4).alias("r"))
    return rows.select("conv_id", "pos", *(c.alias(k) for k, c in tokens.sft_row(F.col("p"), F.col("r"), 768, 2).items()))


def digest_of(ids) -> F.Column:
    """The values of an array of numbers in one string."""
    return F.sha2(F.concat_ws(",", F.transform(ids, lambda x: x.cast("string"))), 256)


def ids_sql(h: str) -> str:
    """The bytes of a text, given as hexadecimal digits, as ids from 4 on."""
    return f"list_transform(range(CAST(length({h}) / 2 AS BIGINT)), lambda i: CAST('0x' || substring({h}, CAST(2 * i + 1 AS INTEGER), 2) AS INTEGER) + 4)"


PROMPT_SQL = f"'[SYSTEM]' || chr(10) || '{SYSTEM}' || chr(10) || chr(10) || '[TASK]' || chr(10) || '{TASK}' || chr(10) || chr(10) || '[DIALOGUE]' || chr(10) || array_to_string(ctx, chr(10)) || chr(10) || chr(10) || '[ANSWER]' || chr(10)"


@query(f"""{CONTEXT}, h AS (SELECT conv_id, pos, hex(encode({PROMPT_SQL})) AS p, hex(encode(response)) AS r FROM x WHERE reason IS NULL),
y AS (SELECT conv_id, pos, {ids_sql('p')} AS p, list_append({ids_sql('r')}, 2) AS r FROM h),
z AS (SELECT conv_id, pos, list_slice(p, greatest(len(p) - greatest(768 - len(r), 0), 0) + 1, len(p)) AS p, list_slice(r, greatest(len(r) - 768, 0) + 1, len(r)) AS r FROM y)
SELECT conv_id, pos, len(p) + len(r) AS n_ids, len(r) AS n_labels, sha256(array_to_string(list_concat(p, r), ',')) AS ids,
sha256(array_to_string(list_concat(list_transform(p, lambda v: -100), r), ',')) AS labels FROM z""")
def sft_token_rows(spark, folder):
    kept = F.size(F.filter("labels", lambda x: x != -100)).cast("bigint")
    return _sft_tokens(spark, folder).select("conv_id", "pos", F.size("input_ids").cast("bigint").alias("n_ids"), kept.alias("n_labels"), digest_of("input_ids").alias("ids"), digest_of("labels").alias("labels"))


CPT_SQL = f"h AS (SELECT conv_id, turn, hex(encode(text)) AS h FROM conversations), r AS (SELECT conv_id, turn, {ids_sql('h')} AS v FROM h), c AS (SELECT conv_id, turn, list_append(list_slice(CASE WHEN len(v) = 0 THEN [2] ELSE v END, greatest(len(v) - 255, 0) + 1, greatest(len(v), 1)), 2) AS v FROM r)"


@query(f"WITH {CPT_SQL} SELECT conv_id, turn, len(v) AS n_ids, sha256(array_to_string(v, ',')) AS ids FROM c")
def cpt_token_rows(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", tokens.byte_ids("text", 4).alias("v"))
    row = tokens.cpt_row(F.col("v"), 256, 2)
    return rows.select("conv_id", "turn", F.size(row["input_ids"]).cast("bigint").alias("n_ids"), digest_of(row["input_ids"]).alias("ids"))


@query(f"""WITH {CPT_SQL}, m AS (SELECT conv_id, turn, v, max(len(v)) OVER (PARTITION BY conv_id) AS padded FROM c)
SELECT conv_id, turn, len(v) AS used, padded, sha256(array_to_string(list_concat(v, list_transform(range(padded - len(v)), lambda i: 0)), ',')) AS ids,
sha256(array_to_string(list_concat(v, list_transform(range(padded - len(v)), lambda i: -100)), ',')) AS labels FROM m""")
def pad_batch(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", tokens.byte_ids("text", 4).alias("v"))
    row = tokens.cpt_row(F.col("v"), 256, 2)
    padded = tokens.pad(rows.select("conv_id", "turn", *(c.alias(k) for k, c in row.items())), "conv_id", 0)
    used = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return padded.select("conv_id", "turn", used.alias("used"), F.size("labels").cast("bigint").alias("padded"), digest_of("input_ids").alias("ids"), digest_of("labels").alias("labels"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def manifest_antijoin(spark, folder):
    return manifest.not_recorded(table(spark, folder, "documents").select("doc_id", "source"), table(spark, folder, "labels").where("quality = 1").select("doc_id"), ["doc_id"])


@query("SELECT lang, doc_id, lang || CASE WHEN n > 1 THEN '__' || n ELSE '' END AS unique_name FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents)")
def unique_names(spark, folder):
    return manifest.numbered_names(table(spark, folder, "documents").select("lang", "doc_id"), "lang", "doc_id")


@query("""WITH d AS (SELECT source, lang FROM documents), l AS (SELECT source, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
a AS (SELECT 'model.' || source AS key, CAST(count(*) AS VARCHAR) AS value FROM d GROUP BY 1 UNION ALL SELECT 'all.' || lang, CAST(count(*) AS VARCHAR) FROM d GROUP BY 1),
b AS (SELECT 'model.' || source AS key, CAST(count(*) AS VARCHAR) AS value FROM l GROUP BY 1 UNION ALL SELECT 'some.' || lang, CAST(count(*) AS VARCHAR) FROM l GROUP BY 1)
SELECT key, coalesce(a.value, '<missing>') AS old, coalesce(b.value, '<missing>') AS new, starts_with(key, 'model.') AS immutable
FROM a FULL JOIN b USING (key) WHERE coalesce(a.value, '<missing>') <> coalesce(b.value, '<missing>')""")
def config_diff(spark, folder):
    """Counts of all documents and of the labelled ones, by source and language, as two configurations."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang")

    def counted(rows, lang):
        of = lambda column, prefix: rows.groupBy(F.concat(F.lit(prefix), column).alias("key")).agg(F.count(F.lit(1)).cast("string").alias("value"))
        return of("source", "model.").union(of("lang", lang))

    labelled = docs.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return manifest.config_diff(counted(docs, "all."), counted(labelled, "some."), ("model.",))


@query("SELECT DISTINCT l_partkey AS step, round(CASE WHEN l_partkey < 100 THEN 0.001 * l_partkey / 100.0 WHEN l_partkey >= 1500 THEN 0.0001 ELSE 0.0001 + 0.5 * (1 + cos(pi() * (l_partkey - 100) / 1400.0)) * (0.001 - 0.0001) END, 9) AS lr FROM lineitem")
def lr_schedule(spark, folder):
    return table(spark, folder, "lineitem").select(F.col("l_partkey").alias("step")).distinct().select("step", F.round(tokens.learning_rate(F.col("step"), rate=0.001, least=0.0001, warm_up=100, decay=1500), 9).alias("lr"))


@query("SELECT l_returnflag, round(coalesce(sum(l_quantity * CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END), 0), avg(l_quantity)), 6) AS loss FROM lineitem GROUP BY 1")
def masked_mean(spark, folder):
    m = F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.round(F.coalesce(F.sum(F.col("l_quantity") * m) / F.nullif(F.sum(m), F.lit(0)), F.avg("l_quantity")), 6).alias("loss"))


@query()
def rate_limited_sends(spark, folder):
    rows = ev(spark, folder).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6))
    return streams.rate_limited(rows, "source_file")


@query()
def seen_buffer(spark, folder):
    return streams.bounded_seen(ev(spark, folder).select("source_file", "seq", "text"), "source_file", "text", 100)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, folder):
    """Users' event types, each once, through a file stream."""
    base = streams.folder(spark, "stream")
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder).select("user_id", "event_type")
    return streams.run_available(streams.unique_rows(stream, ["user_id", "event_type"]), f"{base}/out", f"{base}/state")
