"""Chat files as tables: metadata, last messages, file books, checkpoints, snapshots, reply caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.sources import chat

# Titles, save lines and hints of the exports, the forms of a save time, files of a checkpoint.
TITLE, TITLE_WORDS = rf"^(.+?){T.WS}+카카오톡 대화$", "카카오톡 대화"
SAVED = r"^저장한 날짜 : (.+)$"
SAVED_FORMS = ("yyyy. M. d. H:mm", "yyyy.M.d. H:mm", "yyyy. M. d. H:mm:ss")
EVENT_HINT = r"메시지가 삭제되었습니다|들어왔습니다|나갔습니다|초대했습니다"
EXPORT_LINE = r"^(\d{4}\. \d{1,2}\. \d{1,2}\. \d{1,2}:\d{2}), ([^:]+) : (.+)$"
SIMPLE_LINE = rf"^([^:]{{1,30}}){T.WS}*:{T.WS}*(.+)$"
STATE, ADAPTER, WEIGHTS = "trainer_state.json", "adapter_config.json", ("adapter_model.safetensors", "adapter_model.bin")


def metadata(texts: DataFrame, head: int = 120) -> DataFrame:
    """A row a file: room, save time and month, lines and message lines (those after `head` only if it has none)."""
    rows = chat.lines(texts).withColumn("line", T.strip(F.col("raw")))
    near, full = F.col("line_no") < head, F.col("line") != ""
    saved = F.when(near & F.col("line").rlike(SAVED), T.strip(F.regexp_extract("line", SAVED, 1)))
    each = rows.groupBy("source_file").agg(
        (F.count(F.lit(1)) - F.when(F.max_by("raw", "line_no") == "", 1).otherwise(0)).alias("line_count"),
        F.count_if(near & F.col("line").rlike(chat.HEADER)).alias("_near"), F.count_if(~near & F.col("raw").rlike(chat.HEADER)).alias("_far"),
        F.min_by("line", F.when(full, F.col("line_no"))).alias("_first"), F.min_by(saved, F.when(saved.isNotNull(), F.col("line_no"))).alias("_saved"),
    )
    stem, first = F.regexp_replace("source_file", r"(?<=.)\.[^.]+$", ""), F.coalesce("_first", F.lit(""))
    plain = T.strip(F.replace(first, F.lit(TITLE_WORDS), F.lit("")))
    room = F.when(first.rlike(TITLE), T.strip(F.regexp_extract(first, TITLE, 1))).when(first.contains(TITLE_WORDS) & (plain != ""), plain).otherwise(stem)
    time = F.coalesce(*(F.try_to_timestamp("_saved", F.lit(form)) for form in SAVED_FORMS))
    return each.select(
        "source_file", room.alias("room"), F.coalesce("_saved", F.lit("unknown")).alias("saved_at"), F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("unknown-date")).alias("month"),
        "line_count", F.when(F.col("_near") > 0, F.col("_near")).otherwise(F.col("_far")).alias("message_like"),
    )


def last_message(texts: DataFrame, ignore: str = "") -> DataFrame:
    """The last message line of each file that isn't an event's or the ignored speaker's; no `ts` in the simple form."""
    rows = chat.lines(texts).withColumn("line", T.strip(F.col("raw"))).where((F.col("line") != "") & ~F.col("line").rlike(EVENT_HINT))
    export = F.col("line").rlike(EXPORT_LINE)
    pick = lambda a, b: T.strip(F.when(export, F.regexp_extract("line", EXPORT_LINE, a)).otherwise(F.regexp_extract("line", SIMPLE_LINE, b)))
    rows = rows.withColumns({"ts": F.when(export, F.regexp_extract("line", EXPORT_LINE, 1)), "speaker": pick(2, 1), "text": pick(3, 2)})
    rows = rows.where((F.col("speaker") != "") & (F.col("text") != "") & (F.lit(not ignore) | (F.col("speaker") != ignore)))
    return rows.groupBy("source_file").agg(F.max_by(F.struct("ts", "speaker", "text"), "line_no").alias("m")).select("source_file", "m.*")


def file_book(files: DataFrame, messages: DataFrame) -> DataFrame:
    """Every file with its number of messages and `state`: used, or no_chat_messages."""
    counts = messages.groupBy("source_file").agg(F.count(F.lit(1)).alias("messages"))
    return files.select("source_file").distinct().join(counts, "source_file", "left").select("source_file", F.coalesce("messages", F.lit(0)).alias("messages"), F.when(F.col("messages") > 0, "used").otherwise("no_chat_messages").alias("state"))


def distinct_paths(df: DataFrame, path: str, order: str) -> DataFrame:
    """Paths that differ in more than case, each as first written."""
    return df.groupBy(F.lower(path).alias("_key")).agg(F.min_by(path, order).alias(path), F.min(order).alias(order)).drop("_key")


def changed(df: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """Snapshots that differ from the one before."""
    last = F.lag(F.sha1(text)).over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("_last", last).where(~F.sha1(text).eqNullSafe(F.col("_last"))).drop("_last")


def reply_slots(df: DataFrame, batch: str, order: str, most: int) -> DataFrame:
    """`slot`: the first `most` rows of a batch are reply, the others context."""
    k = F.row_number().over(Window.partitionBy(batch).orderBy(order))
    return df.withColumn("slot", F.when(k <= most, "reply").otherwise("context"))


def start_target(df: DataFrame, ignore: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The last turn of each conversation that isn't of an ignored role."""
    return df.where(~F.col("role").isin(*ignore)).groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text"))


def checkpoints(files: DataFrame, strict: bool = True) -> DataFrame:
    """`run`, `dir`, `step` of checkpoints that have all their files; not `strict`: the trainer's state may lack."""
    has = lambda *names: F.bool_or(F.col("file").isin(*names))
    whole = has(ADAPTER) & has(*WEIGHTS) & (has(STATE) if strict else F.lit(True))
    step = F.regexp_extract("dir", r"^checkpoint-(\d+)$", 1)
    return files.where(step != "").groupBy("run", "dir").agg(whole.alias("_whole")).where("_whole").select("run", "dir", step.cast("bigint").alias("step"))


def latest(df: DataFrame, keys: list[str], item: str, order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(item, order).alias(item), F.max(order).alias(order))


def expired(df: DataFrame, keys: list[str], order: str, keep: int) -> DataFrame:
    """Rows past the newest `keep` of their group."""
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("_k", k).where(F.col("_k") > keep).drop("_k")


def seeds(df: DataFrame, room: str, order: str, speaker: str, *, last: int = 20, ignore: tuple[str, ...] = (), bot: str = "", reply: bool = True) -> DataFrame:
    """The last rows of each room as a bridge starts with them, with `slot`: reply for the newest that neither the bot nor an ignored speaker wrote, else bot or user.

    Ignored speakers count among the last rows, but aren't returned; without `reply` no row is a reply.
    """
    name = F.coalesce(F.col(speaker), F.lit(""))
    own, silent = (name == bot) & F.lit(bool(bot)), name.isin(*ignore) if ignore else F.lit(False)
    rows = df.withColumn("_back", F.row_number().over(Window.partitionBy(room).orderBy(F.desc(order)))).where(F.col("_back") <= last)
    asks = F.when(~own & ~silent, F.col("_back"))
    first = F.min(asks).over(Window.partitionBy(room))
    slot = F.when(F.lit(reply) & (asks == first), "reply").when(own, "bot").otherwise("user")
    return rows.withColumn("slot", slot).where(~silent).drop("_back")


def run_to_serve(runs: DataFrame, group: str, wanted: Column) -> DataFrame:
    """One of the runs (`run`, `modified`, `adapter`) of each group that have an adapter: the wanted one, else the one of its first stage, else the newest."""
    first = F.when(~F.endswith(wanted, F.lit("_cpt")), F.concat(wanted, F.lit("_cpt")))
    choice = F.when(F.col("run") == wanted, 2).when(F.col("run") == first, 1).otherwise(0)
    usable = runs.where(F.coalesce("adapter", F.lit("")) != "")
    return usable.groupBy(group).agg(F.max_by(F.struct("run", "adapter"), F.struct(choice, "modified", "run")).alias("_r")).select(group, "_r.run", "_r.adapter")
