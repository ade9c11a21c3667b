"""Ranked hits as text: context, prompts, source lists, conversation history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cut, trim_ws

# The texts put around hits and questions.
PIECE_HEAD = "來源: "
PIECE_GAP = "\n\n---\n\n"
PROMPT_HEAD = (
    "根據以下提供的資訊回答問題，如果提供的資訊不足以回答，請清楚表明。不要擅自添加未在資料中提及的資訊。\n"
    "            \n提供的資訊:\n"
)
PROMPT_QUESTION = "\n\n問題: "
PROMPT_TAIL = "\n\n回答:"
HISTORY_HEAD = "歷史對話："
HISTORY_TAIL = "以上回歷史路。 本次對話："
STATUS_ANSWERS = {
    "no_embedding": "無法為查詢生成 embedding，請確認 embedding service / model 可用。",
    "no_hits": "索引中沒有可用的檢索結果。",
}
NO_MODEL_ANSWER = "未配置 LLM 模型，僅提供檢索結果。"
FAILED_ANSWER = "無法連線到 LLM 服務，但已成功檢索相關內容。請查看檢索結果或稍後再試。"
EMBEDDING_ERROR = " 最後的 embedding 錯誤: "
ANSWER_ERROR = "生成回答時發生錯誤: "
SOURCE_NAME = ". source="
SOURCE_DISTANCE = ", distance="
REFERENCE_SOURCE = "- Source: "
REFERENCE_DISTANCE = " (distance="
REFERENCE_CONTENT = ")\n  Content:\n  "
REFERENCE_CUT = "... (truncated, total length: "
REFERENCE_CUT_END = " characters)"
REFERENCE_IMAGES = "  Images: "
REFERENCE_IMAGES_END = " found\n"
ANSWER_HEAD = "Answer:\n"
ANSWER_SOURCES = "\n\nSources:\n"
SOURCE_CHARS = 700
REFERENCE_CHARS = 500

_BLOCK = 4096


def _in_rank_order(hits: DataFrame, piece: Column, gap: str, name: str) -> DataFrame:
    """One text per query; a query has at most as many pieces as hits were asked for."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), piece.alias("piece"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda p: p["piece"]), gap).alias(name))


def build_context(hits: DataFrame, head: str = PIECE_HEAD, gap: str = PIECE_GAP) -> DataFrame:
    """``query_id``, ``context``: source and text of each hit in rank order."""
    return _in_rank_order(hits, F.concat(F.lit(head), F.col("source"), F.lit("\n\n"), F.col("text")), gap, "context")


def build_prompts(
    contexts: DataFrame, head: str = PROMPT_HEAD, middle: str = PROMPT_QUESTION, tail: str = PROMPT_TAIL
) -> DataFrame:
    """Add ``prompt`` to ``(query, context)``."""
    return contexts.withColumn(
        "prompt", F.concat(F.lit(head), F.col("context"), F.lit(middle), F.col("query"), F.lit(tail))
    )


def format_sources(hits: DataFrame, max_chars: int = SOURCE_CHARS) -> DataFrame:
    """``query_id``, ``sources``: numbered sources with distance and one line of text each."""
    line = cut(trim_ws(F.replace("text", F.lit("\n"), F.lit(" "))), max_chars)
    piece = F.concat(
        F.col("rank").cast("string"),
        F.lit(SOURCE_NAME),
        F.col("source"),
        F.lit(SOURCE_DISTANCE),
        F.printf(F.lit("%.4f"), F.col("distance")),
        F.lit("\n"),
        line,
    )
    return _in_rank_order(hits, piece, "\n\n", "sources")


def format_references(hits: DataFrame, max_chars: int = REFERENCE_CHARS) -> DataFrame:
    """``query_id``, ``refs``: source, distance, text with its full length if cut, and number of images."""
    text = F.col("text")
    tail = F.concat(F.lit(REFERENCE_CUT), F.length(text).cast("string"), F.lit(REFERENCE_CUT_END))
    body = F.when(F.length(text) > max_chars, F.concat(F.left(text, F.lit(max_chars)), tail)).otherwise(text)
    images = F.when(
        F.col("image_count") > 0, F.concat(F.lit(REFERENCE_IMAGES), F.col("image_count").cast("string"), F.lit(REFERENCE_IMAGES_END))
    ).otherwise("")
    piece = F.concat(
        F.lit(REFERENCE_SOURCE),
        F.col("source"),
        F.lit(REFERENCE_DISTANCE),
        F.printf(F.lit("%.3f"), F.col("distance")),
        F.lit(REFERENCE_CONTENT),
        body,
        F.lit("\n"),
        images,
    )
    return _in_rank_order(hits, piece, "\n", "refs")


def answer_text(answer: Column, sources: Column) -> Column:
    """Answer with its sources, or alone if there are none."""
    sources = F.coalesce(sources, F.lit(""))
    return F.when(sources == "", answer).otherwise(
        F.concat(F.lit(ANSWER_HEAD), answer, F.lit(ANSWER_SOURCES), sources)
    )


def status_answer(
    status: Column, answer: Column | None = None, asked: bool = True, error: Column | None = None, answer_error: Column | None = None
) -> Column:
    """What is said to a query: the answer of a model if there is one, else why there is none.

    ``error`` is the text of the embedding's failure, ``answer_error`` that of the answer's; null where there was none.
    """
    none = F.lit(None).cast("string")
    given = none if answer is None else answer
    failed = F.concat(F.lit(ANSWER_ERROR), none if answer_error is None else answer_error)
    said = F.coalesce(given, failed, F.lit(FAILED_ANSWER if asked else NO_MODEL_ANSWER))
    detail = F.coalesce(F.concat(F.lit(EMBEDDING_ERROR), none if error is None else error), F.lit(""))
    for name, text in STATUS_ANSWERS.items():
        why = F.concat(F.lit(text), detail) if name == "no_embedding" else F.lit(text)
        said = F.when(status == name, why).otherwise(said)
    return said


def answer_records(status: DataFrame, hits: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """One row per query: ``query_id``, ``status``, ``answer`` and its hits in rank order as ``retrieved``.

    ``answers(query_id, answer)`` is what a model made of the prompts, with its ``error`` if it has that column. Queries
    without hits have an empty list. Of several answers to one query the last in order of text counts. Where ``status``
    has an ``error``, it ends the answer of a query without embedding and is a column here too.
    """
    fields = [F.col(c) for c in ("rank", "text", "source", "distance", "images") if c in hits.columns]
    found = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("retrieved"))
    rows = status.join(found, "query_id", "left")
    answer = answer_error = None
    if answers is not None:
        kept = [F.max("answer").alias("answer")]
        if "error" in answers.columns:
            kept.append(F.max("error").alias("_answer_error"))
            answer_error = F.col("_answer_error")
        rows = rows.join(answers.groupBy("query_id").agg(*kept), "query_id", "left")
        answer = F.col("answer")
    error = F.col("error") if "error" in status.columns else None
    kind = found.schema["retrieved"].dataType
    return rows.select(
        "query_id",
        "status",
        status_answer(F.col("status"), answer, answers is not None, error, answer_error).alias("answer"),
        F.coalesce("retrieved", F.array().cast(kind)).alias("retrieved"),
        *([] if error is None else [error]),
    )


def turn_positions(conversations: DataFrame) -> DataFrame:
    """Add ``pos``, the place of each turn in its conversation from 0, without gathering any conversation.

    Turns are counted per stretch of turn numbers; what lies before a stretch comes from those counts alone.
    """
    stretch = F.floor(F.col("turn") / _BLOCK)
    rows = conversations.withColumn("_stretch", stretch)
    counts = rows.groupBy("conv_id", "_stretch").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("conv_id", "_stretch").orderBy("turn")
    return (
        rows.join(starts, ["conv_id", "_stretch"])
        .withColumn("pos", F.col("_start") + F.row_number().over(within) - 1)
        .drop("_stretch", "_start")
    )


def history_prompts(
    conversations: DataFrame, max_turns: int = 10, head: str = HISTORY_HEAD, tail: str = HISTORY_TAIL, gap: str = "\n"
) -> DataFrame:
    """Add ``history`` (texts of up to ``max_turns`` turns before) and ``prompt`` to each turn.

    ``(conv_id, turn)`` is the key. Long conversations are cut into blocks of positions, and the last turns of a
    block are also handed to the next, so no task ever holds a whole conversation.
    """
    size = max(_BLOCK, max_turns)
    block = F.floor(F.col("pos") / size)
    offset = F.col("pos") % size
    homes = F.when(offset >= size - max_turns, F.array(block, block + 1)).otherwise(F.array(block))
    spread = turn_positions(conversations).withColumn("_home", block).withColumn("_block", F.explode(homes))
    before = Window.partitionBy("conv_id", "_block").orderBy("pos").rowsBetween(-max_turns, -1)
    history = F.array_join(F.collect_list("text").over(before), gap)
    return (
        spread.withColumn("history", history)
        .where(F.col("_block") == F.col("_home"))
        .withColumn("prompt", F.concat(F.lit(head), F.col("history"), F.lit(tail), F.col("text")))
        .select(*conversations.columns, "history", "prompt")
    )
