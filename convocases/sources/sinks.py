"""Outputs: full results, labels on the original table, case exports, the log of model calls."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from convocases.operators.blocks import join_spread
from convocases.operators.cases import cases_to_messages_range

MESSAGES_PER_OBJECT = 1_000
LOG_SAMPLE, LOG_SAMPLE_CHARS = 3, 100


def write_messages(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def label_writeback_lookup(final: DataFrame, keys: Sequence[str] = ("message_id",)) -> DataFrame:
    """`keys` to their last non-empty case number and category, by time and ingest order."""
    place = F.struct("created_time", "ingest_seq")

    def last(column):
        filled = F.coalesce(F.col(column), F.lit("")) != ""
        return F.max_by(column, F.when(filled, place)).alias(column)

    return final.groupBy(*keys).agg(last("case_number"), last("category"))


def with_labels(original: DataFrame, final: DataFrame) -> DataFrame:
    """The original rows with only `case_number`, `category` and `review` added; old values stay where no new one is.

    Rows meet by channel and message id where both tables name the channel, so an id used in two channels keeps them
    apart; else by message id alone.
    """
    keys = [c for c in ("channel_url", "message_id") if c in original.columns and c in final.columns]
    labels = label_writeback_lookup(final, keys).select(
        *keys, F.col("case_number").alias("_case_number"), F.col("category").alias("_category")
    )
    spread = [c for c in ("ingest_seq", "created_time") if c in original.columns]
    joined = join_spread(original, labels, keys, spread=spread)
    for name in ("case_number", "category"):
        old = [F.col(name)] if name in original.columns else []
        joined = joined.withColumn(name, F.coalesce(F.col(f"_{name}"), *old, F.lit("")))
    if "review" not in original.columns:
        joined = joined.withColumn("review", F.lit(""))
    return joined.drop("_case_number", "_category")


def write_back_labels(original: DataFrame, final: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Labels on the original table, always to a new path."""
    write_messages(with_labels(original, final), path, fmt)


def case_objects(cases: DataFrame, positioned: DataFrame, messages_per_object: int = MESSAGES_PER_OBJECT) -> DataFrame:
    """One nested row per case, `messages` in order; a longer case continues in further rows (`part`)."""
    ranges = cases.select("case_number", "channel_url", "start_pos", "end_pos")
    rows = cases_to_messages_range(ranges, positioned)
    part = F.floor((F.col("pos") - F.col("start_pos")) / messages_per_object).cast("int").alias("part")
    message = F.struct("pos", "message_id", "created_time", "sender_id", "sender_type", "type", "message")
    nested = rows.groupBy("case_number", part).agg(F.sort_array(F.collect_list(message)).alias("messages"))
    heads = cases.select(
        "case_number", "channel_url", "start_time", "end_time", "duration_minutes", "participants", "summary", "confidence"
    )
    joined = heads.join(nested, ["case_number"])
    return joined.withColumnRenamed("case_number", "case_id")


def export_cases_json(cases: DataFrame, positioned: DataFrame, path: str, **options) -> None:
    case_objects(cases, positioned, **options).write.json(path)


def export_cases_csv(cases: DataFrame, path: str) -> None:
    """One row per case; participants joined by semicolons."""
    write_messages(cases.withColumn("participants", F.array_join("participants", ";")), path, "csv")


def message_sample(requests: DataFrame, positioned: DataFrame) -> DataFrame:
    """`request_id, sample`: the first three messages of each request, found by (channel, position).

    Requests about a case count from its `start_pos`.
    """
    offset = F.col("start_pos") - 1 if "start_pos" in requests.columns else F.lit(0)
    last = F.least(F.col("last_pos"), F.col("first_pos") + LOG_SAMPLE - 1)
    wanted = requests.select(
        "request_id", "channel_url", offset.alias("_offset"), F.posexplode(F.sequence("first_pos", last)).alias("_n", "_at")
    ).select("request_id", "channel_url", "_n", (F.col("_at") + F.col("_offset")).alias("pos"))
    found = positioned.select("channel_url", "pos", "sender_id", "message").join(wanted, ["channel_url", "pos"])
    line = F.format_string(
        "Message %d: [%s] %s...", F.col("_n") + 1, F.col("sender_id"), F.substring("message", 1, LOG_SAMPLE_CHARS)
    )
    lines = found.groupBy("request_id").agg(F.sort_array(F.collect_list(F.struct("_n", line.alias("_line")))).alias("_s"))
    return lines.select("request_id", F.array_join(F.transform("_s", lambda x: x["_line"]), "\n").alias("sample"))


def interaction_log(requests: DataFrame, replies: DataFrame, positioned: DataFrame | None = None) -> DataFrame:
    """One audit row per answered request: call, status, cost, texts, and a message sample where it has positions."""
    answers = replies.select(
        "request_id", "content", "model", "provider", "input_tokens", "output_tokens", "seconds", "error"
    )
    status = F.when(F.col("error").isNull() & F.col("content").isNotNull(), "success").otherwise("error")
    known = [c for c in ("channel_url", "case_index", "case_number") if c in requests.columns]
    joined = requests.select("request_id", "call_type", *known, "n_messages", "prompt").join(answers, ["request_id"])
    if positioned is not None and "first_pos" in requests.columns:
        joined = joined.join(message_sample(requests, positioned), ["request_id"], "left")
    return joined.withColumns({"status": status, "response_length": F.length("content")})


def write_interaction_log(log: DataFrame, path: str) -> None:
    log.write.partitionBy("call_type", "status").parquet(path)
