"""The model in the loop: every round asks for one window of each open channel and takes out the cases that are complete."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from convocases.functions import text
from convocases.operators.blocks import Cuts
from convocases.operators.messages import drop_untimed, message_positions
from convocases.operators.replies import FAILED_CONFIDENCE, FAILED_SUMMARY, NO_REPLY_CONFIDENCE, NO_REPLY_SUMMARY, first_good_reply, proposals, validate_segmentation
from convocases.plans.requests import SEGMENT_TASK, message_line
from convocases.sources.scratch import checkpointed, new_path

BOUNDARY = (
    "channel_url string, channel_seq long, channel_messages long, case_index long, start_pos long, end_pos long, summary string,"
    " confidence double, forced_ending boolean, forced_starting boolean"
)
_RANGE = "array<struct<case_index: bigint, start_pos: bigint, end_pos: bigint, summary: string, confidence: double>>"


def window_requests(frontier: DataFrame, positioned: DataFrame, size: int, number: int, task: str = SEGMENT_TASK) -> DataFrame:
    """One request for each open channel: its next `size` messages, numbered as in the channel.

    Messages and frontier meet by (channel, block of `size` positions), at most two blocks a channel, so no channel
    meets as a whole and a request holds `size` messages at most.
    """
    first = F.col("next_pos")
    wanted = frontier.select("*", F.explode(F.sequence(F.floor(first / size), F.floor((first + size - 1) / size))).alias("_block"))
    rows = positioned.withColumn("_block", F.floor(F.col("pos") / size)).join(wanted, ["channel_url", "_block"])
    rows = rows.where((F.col("pos") >= first) & (F.col("pos") < first + size))
    lines = F.sort_array(F.collect_list(F.struct("pos", message_line(F.col("pos")).alias("line"))))
    asked = rows.groupBy(*frontier.columns).agg(
        F.max("pos").alias("last_pos"), F.concat(F.lit(task), F.array_join(F.transform(lines, lambda x: x["line"]), "")).alias("prompt"))
    return asked.select(
        F.concat_ws(":", F.lit("queue"), F.lit(str(number)), "channel_url").alias("request_id"), F.lit("segment").alias("call_type"), *frontier.columns,
        F.col("next_pos").alias("first_pos"), "last_pos", "prompt", text.approx_tokens(F.col("prompt")).alias("prompt_tokens"))


def read_windows(asked: DataFrame, replies: DataFrame) -> DataFrame:
    """Requests (without prompts) with the cases to take out, `taken`, and where their channel goes on, `then_pos` and `then_forced`.

    A case is complete if it ends before the window does, or if the window holds the channel's last message. The channel
    goes on at the first case that is not. Where that is the whole window, the queue is full: the case is cut there. A
    window without usable reply is one case, cut at its end.
    """
    answers = validate_segmentation(first_good_reply(replies.select("request_id", "content", "error")))
    rows = asked.join(answers.withColumn("_answered", F.lit(True)), ["request_id"], "left")
    ok = F.col("_answered").isNotNull() & F.col("error").isNull() & F.col("reason").isNull()
    given = F.filter(proposals(F.lit(0)), lambda c: (c["start_pos"] <= c["end_pos"]) & (c["start_pos"] >= 1) & (c["end_pos"] <= F.col("channel_messages"))
                     & c["confidence"].isNotNull() & (c["start_pos"] <= F.col("last_pos")) & (c["end_pos"] >= F.col("first_pos")))
    cut = F.transform(given, lambda c: F.struct(
        c["case_index"], F.greatest(c["start_pos"], "first_pos").alias("start_pos"), F.least(c["end_pos"], "last_pos").alias("end_pos"), c["summary"], c["confidence"]))
    missing = F.col("_answered").isNull()
    fallback = F.array(F.struct(
        F.lit(0).cast("long").alias("case_index"), F.col("first_pos").alias("start_pos"), F.col("last_pos").alias("end_pos"),
        F.when(missing, NO_REPLY_SUMMARY).otherwise(FAILED_SUMMARY).alias("summary"),
        F.when(missing, NO_REPLY_CONFIDENCE).otherwise(FAILED_CONFIDENCE).alias("confidence")))
    rows = rows.withColumn("_ranges", F.when(ok, cut).otherwise(fallback).cast(_RANGE))
    at_end, last = F.col("last_pos") == F.col("channel_messages"), F.col("last_pos")
    rows = rows.withColumn("_open", F.array_min(F.transform(F.filter("_ranges", lambda c: c["end_pos"] == last), lambda c: c["start_pos"])))
    full = ~at_end & (F.col("_open") == F.col("first_pos"))
    ends = F.array_max(F.transform("_ranges", lambda c: c["end_pos"]))
    return rows.withColumns({
        "taken": F.when(at_end | full, F.col("_ranges")).otherwise(F.filter("_ranges", lambda c: c["end_pos"] < last)),
        "then_pos": F.when(at_end | full, last + 1).otherwise(F.coalesce("_open", ends + 1, last + 1)),
        "then_forced": F.coalesce(full, F.lit(False)),
    }).select(*[c for c in asked.columns if c != "prompt"], "taken", "then_pos", "then_forced")


def segment_by_queue(
    messages: DataFrame, answer: Callable[[DataFrame], DataFrame], size: int = 50, cuts: Cuts | None = None, task: str = SEGMENT_TASK,
) -> DataFrame:
    """Boundary rows (BOUNDARY, for `pipeline.segment_with_boundaries`) from a model asked window by window.

    `answer` makes the reply table of a request table, as `requests.call_requests` does with a client. A round asks once
    for every channel that is not done, so there are as many rounds as the longest channel has windows, and channels do
    not wait for each other within a round. Requests and replies of a round are written before they are read, so no call
    is repeated when a task is lost. The messages still ahead are written anew whenever they have become half as many.
    `size` bounds what a case may hold; a longer one is cut, with forced_ending and forced_starting.
    """
    spark = messages.sparkSession
    fields = ("channel_url", "pos", "created_time", "sender_id", "sender_type", "message", "ingest_seq")
    ahead = checkpointed(message_positions(drop_untimed(messages), cuts).select(*fields))
    frontier = checkpointed(ahead.groupBy("channel_url").agg(
        F.min("ingest_seq").alias("channel_seq"), F.max("pos").alias("channel_messages"), F.lit(1).cast("long").alias("next_pos"),
        F.lit(0).cast("long").alias("so_far"), F.lit(False).alias("forced")))
    out = new_path(spark, "boundaries")
    left = written = frontier.agg(F.coalesce(F.sum("channel_messages"), F.lit(0))).first()[0]
    spark.createDataFrame([], BOUNDARY).write.parquet(out)
    number = 0
    while left:
        asked = checkpointed(window_requests(frontier, ahead, size, number, task))
        replies = checkpointed(answer(asked))
        done = checkpointed(read_windows(asked, replies))
        cases = done.select("*", F.posexplode("taken").alias("_nth", "_case"))
        first, last = F.col("_case.start_pos") == F.col("first_pos"), F.col("_case.end_pos") == F.col("last_pos")
        cases.select(
            "channel_url", "channel_seq", "channel_messages", (F.col("so_far") + F.col("_nth")).alias("case_index"), "_case.start_pos", "_case.end_pos",
            "_case.summary", "_case.confidence", (F.col("then_forced") & last).alias("forced_ending"), (F.col("forced") & first).alias("forced_starting"),
        ).write.mode("append").parquet(out)
        frontier = checkpointed(done.where(F.col("then_pos") <= F.col("channel_messages")).select(
            "channel_url", "channel_seq", "channel_messages", F.col("then_pos").alias("next_pos"), (F.col("so_far") + F.size("taken")).alias("so_far"),
            F.col("then_forced").alias("forced")))
        left = frontier.agg(F.coalesce(F.sum(F.col("channel_messages") - F.col("next_pos") + 1), F.lit(0))).first()[0]
        if left and 2 * left <= written:
            ahead = checkpointed(ahead.join(frontier.select("channel_url", "next_pos"), ["channel_url"]).where("pos >= next_pos").select(*fields))
            written = left
        number += 1
    return spark.read.schema(BOUNDARY).parquet(out)
