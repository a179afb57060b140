"""Live message feeds: cleaning, sessions, and a per-channel queue that emits finished cases."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Step
from convocases.operators.cases import forced_endings
from convocases.operators.messages import clean_messages, drop_untimed, in_channel_order
from convocases.operators.segment import Rules, first_match, opening


def stream_messages(raw: DataFrame, straighten: bool = False) -> DataFrame:
    """The batch cleaning on a stream: no state, the same columns."""
    return clean_messages(raw, straighten)


def stream_sessions(messages: DataFrame, gap: str = "4 hours", late: str = "1 day") -> DataFrame:
    """Sessions per channel on a stream; a session is out once the watermark has passed its end.

    Sessions of a hot channel shrink in the map tasks if
    `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition` is on.
    """
    windowed = drop_untimed(messages).withWatermark("created_time", late)
    return windowed.groupBy("channel_url", F.session_window("created_time", gap).alias("_w")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.max("created_time").alias("end_time")
    ).select("channel_url", F.col("_w.start").alias("start_time"), "end_time", "n_messages")


def sessions(messages: DataFrame, gap_hours: float = 4, cuts: Cuts | None = None) -> DataFrame:
    """The same sessions on a table, for channels of any size: a longer gap opens a new one."""
    o = in_channel_order(drop_untimed(messages), cuts)
    o = blocks.scan(o, _before=Step("lag", F.col("created_time")))
    gap = (F.unix_micros("created_time") - F.unix_micros("_before")) / 3.6e9
    opens = (F.col("_before").isNull() | (gap > gap_hours)).cast("long")
    rows = blocks.finish(blocks.scan(o, _session=Step("sum", opens)))
    return rows.groupBy("channel_url", "_session").agg(
        F.min("created_time").alias("start_time"), F.max("created_time").alias("end_time"),
        F.count(F.lit(1)).alias("n_messages"),
    ).drop("_session")


OPEN_CASE = (
    "channel_url string, case_index long, start_pos long, end_pos long, segment_start long, start_time timestamp, "
    "end_time timestamp, ref string, confidence double, forced_starting boolean"
)
ARRIVAL = ["_turn", "created_time", "ingest_seq", "message_id"]


def advance_cases(
    open_cases: DataFrame, batch: DataFrame, rules: Rules = Rules(), max_queue_size: int = 128,
    rows_per_block: int = blocks.ROWS_PER_BLOCK,
) -> DataFrame:
    """Cases of each channel after one more batch of messages, from its open case (`OPEN_CASE`) and the batch.

    The open case joins its channel as one row ahead of the new messages; the boundary rules and the forced
    cuts then run as on a table, in blocks where the batch holds much of one channel. `open` marks the last
    case of each channel, all others are finished.
    """
    new = drop_untimed(batch).select(
        "channel_url", F.lit(1).alias("_turn"), "created_time", "ingest_seq", "message_id", "message",
        first_match(F.col("message"), rules.ref_pattern).alias("ref"),
    )
    fields = ("case_index", "start_pos", "end_pos", "segment_start", "start_time", "confidence", "forced_starting")
    old = open_cases.select(
        "channel_url", F.lit(0).alias("_turn"), F.col("end_time").alias("created_time"),
        F.lit(0).cast("long").alias("ingest_seq"), F.lit("").alias("message_id"), F.lit("").alias("message"),
        "ref", F.struct(*fields).alias("_kept"),
    )
    rows = new.unionByName(old, allowMissingColumns=True)
    o = blocks.in_blocks(rows, ["channel_url"], ARRIVAL, rows_per_block=rows_per_block)
    o = blocks.scan(
        o, _nth=Step("row_number"), previous_time=Step("lag", F.col("created_time")),
        previous_ref=Step("last", F.col("ref")), _was=Step("least", F.col("_kept")),
    )
    is_new, had = F.col("_turn") == 1, F.col("_was").isNotNull()
    rule, score = opening(rules).values()
    o = o._replace(rows=o.rows.withColumn("rule", F.when(is_new, rule)))
    o = o._replace(rows=o.rows.withColumns({
        "pos": F.when(had, F.col("_was.end_pos") - 1).otherwise(0) + F.col("_nth"),
        "boundary_confidence": score,
        "_ref": F.coalesce("ref", "previous_ref"),
    }))
    o = blocks.scan(
        o, _opened_at=Step("max", F.when(F.col("rule").isNotNull(), F.col("pos"))),
        _opened_with=Step("last", F.col("boundary_confidence")),
    )
    segment_start = F.coalesce("_opened_at", "_was.segment_start")
    in_segment = F.col("pos") - segment_start
    opens = is_new & (in_segment % max_queue_size == 0)
    o = o._replace(rows=o.rows.withColumns({
        "segment_start": segment_start,
        "confidence": F.coalesce("boundary_confidence", "_opened_with", "_was.confidence"),
        "forced_starting": F.coalesce("_kept.forced_starting", opens & (in_segment > 0)),
        "_opens": opens.cast("long"),
    }))
    o = blocks.scan(o, _sum=Step("sum", F.col("_opens")), _all=Step("total", F.col("_opens")))
    base = F.when(had, F.col("_was.case_index")).otherwise(-1)
    rows = blocks.finish(o).withColumns({"case_index": base + F.col("_sum"), "open": F.col("_sum") == F.col("_all")})
    cases = rows.groupBy("channel_url", "case_index").agg(
        F.min(F.coalesce("_kept.start_pos", "pos")).alias("start_pos"), F.max("pos").alias("end_pos"),
        F.min("segment_start").alias("segment_start"),
        F.min(F.coalesce("_kept.start_time", "created_time")).alias("start_time"),
        F.max("created_time").alias("end_time"), F.max_by("_ref", "pos").alias("ref"),
        F.max("confidence").alias("confidence"), F.max("forced_starting").alias("forced_starting"),
        F.max("open").alias("open"),
    )
    return forced_endings(cases).withColumn("n_messages", F.col("end_pos") - F.col("start_pos") + 1)


def stream_sliding_queue(
    messages: DataFrame, folder: str, rules: Rules = Rules(), max_queue_size: int = 128
) -> DataStreamWriter:
    """A writer that turns a message stream into finished cases under `folder`; set its checkpoint and start it.

    Every micro-batch writes one table, `folder/batch=N`, with the cases it finished and the open case of
    every channel, which the next one reads. A batch that runs again overwrites its own table. Messages of a
    batch are taken in time order; one that comes in a later batch counts as next.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number:
            before = spark.read.schema(OPEN_CASE + ", open boolean").parquet(f"{folder}/batch={number - 1}").where("open")
        else:
            before = spark.createDataFrame([], OPEN_CASE)
        cases = advance_cases(before.drop("open"), batch, rules, max_queue_size)
        cases.write.mode("overwrite").partitionBy("open").parquet(f"{folder}/batch={number}")

    return messages.writeStream.foreachBatch(step)


def finished_cases(spark: SparkSession, folder: str, idle: str | None = None) -> DataFrame:
    """Cases that the batches under `folder` have finished.

    With `idle`, an interval, also the open cases of the last batch whose channel has been silent for so long, counted
    to the newest message of all channels: "0 seconds" gives every case of a feed that has ended. A message that comes
    later may still prolong such a case.
    """
    schema = OPEN_CASE + ", forced_ending boolean, n_messages long, open boolean, batch long"
    cases = spark.read.schema(schema).parquet(folder)
    done = F.col("open") == F.lit(False)
    if idle is not None:
        last, newest = cases.agg(F.max("batch"), F.max("end_time")).first()
        silent = F.col("end_time") <= F.lit(newest) - F.expr(f"interval {idle}")
        done = done | (F.col("open") & (F.col("batch") == last) & silent)
    return cases.where(done).drop("open", "batch", "segment_start", "ref")
