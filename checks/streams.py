"""Queries: streams over the driver's tables, read to the end and given back as tables."""

from pyspark.sql import functions as F

from checks import adapters as a, bases as b
from checks.ctes import sql
from checks.registry import query
from convocases.sources.scratch import new_path
from convocases.streaming import live, queue, slices

FILES = 4
#: Rows of a feed that a task writes, and groups when it reads them.
ROWS_PER_FILE = 1_000_000


def as_stream(spark, df, files: int = 1, per_batch: int = 1):
    """The rows as a feed of files, cut by ingest order."""
    path = new_path(spark, "feed")
    df.repartitionByRange(files, "ingest_seq").write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def in_time_order(spark, df, batches: int):
    """The timed rows as a feed of micro-batches of FILES files, cut at times; a batch is written after the one before."""
    df = df.where("created_time is not null")
    path = new_path(spark, "feed")
    shares = [i / batches for i in range(1, batches)]
    times = [None, *df.select(F.unix_micros("created_time").alias("t")).approxQuantile("t", shares, 0.01), None]
    for low, high in zip(times, times[1:]):
        rows = df if low is None else df.where(F.unix_micros("created_time") >= int(low))
        rows = rows if high is None else rows.where(F.unix_micros("created_time") < int(high))
        rows.repartition(FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def finish(spark, writer) -> None:
    writer = writer.option("checkpointLocation", new_path(spark, "progress")).trigger(availableNow=True)
    writer.start().awaitTermination()


def drained(spark, stream):
    path = new_path(spark, "drained")
    finish(spark, stream.writeStream.format("parquet").outputMode("append").option("path", path))
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_messages", sql("SELECT ingest_seq, message, created_time, sender_type FROM x1", "x1"))
def stream_messages(spark, sf):
    rows = drained(spark, live.stream_messages(as_stream(spark, a.x1_raw(spark, sf), files=3)))
    return rows.select("ingest_seq", "message", "created_time", "sender_type")


SESSIONS = """
, s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 14400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY channel_url ORDER BY created_time, ingest_seq, message_id ROWS UNBOUNDED PRECEDING) AS k FROM m2_rule)
SELECT channel_url, min(created_time) AS start_time, max(created_time) AS end_time, count(*) AS n_messages FROM s GROUP BY channel_url, k"""


@query("stream_sessions", sql(SESSIONS, "m2_rule"))
def stream_sessions(spark, sf):
    """Sessions of the event stream; one copied row, set far ahead, moves the watermark past them all.

    All come in one micro-batch, of as many files as their number asks for.
    """
    files = -(-a.table(spark, sf, "events").count() // ROWS_PER_FILE) or 1
    stream = as_stream(spark, with_one_ahead(a.m2(spark, sf)), files, files)
    return drained(spark, live.stream_sessions(stream)).where("channel_url <> 'ahead'")


def with_one_ahead(rows):
    ahead = rows.orderBy("ingest_seq").limit(1).withColumns({
        "channel_url": F.lit("ahead"), "created_time": F.expr("created_time + interval 400 days"),
    })
    return rows.unionByName(ahead)


@query("stream_sessions_in_slices", sql(SESSIONS, "m2_rule"))
def stream_sessions_in_slices(spark, sf):
    """The same by slices of an hour, from several files."""
    for name, value in queue.STATE_STORE.items():
        spark.conf.set(name, value)
    stream = as_stream(spark, with_one_ahead(a.m2(spark, sf)), FILES, FILES)
    return drained(spark, slices.stream_sessions_in_slices(stream)).where("channel_url <> 'ahead'")


@query("sessions", sql(SESSIONS, "m2_rule"))
def sessions(spark, sf):
    return live.sessions(a.m2(spark, sf))


PIECES = """
, segs AS (SELECT channel_url, case_index AS s, min(pos) AS first_pos, count(*) AS len, max(boundary_confidence) AS confidence FROM m2_seg GROUP BY 1, 2),
pieces AS (SELECT m.channel_url, g.s, (m.pos - first_pos) // 3 AS piece, min(m.pos) AS start_pos, max(m.pos) AS end_pos, min(created_time) AS start_time,
  max(created_time) AS end_time, count(*) AS n_messages, any_value(len) AS len, any_value(confidence) AS confidence
  FROM m2_seg m JOIN segs g ON m.channel_url = g.channel_url AND m.case_index = g.s GROUP BY 1, 2, 3),
queued AS (SELECT channel_url, case_index, start_pos, end_pos, start_time, end_time, n_messages, confidence, forced_starting, forced_ending FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_url ORDER BY start_pos) - 1 AS case_index,
    piece > 0 AS forced_starting, (piece + 1) * 3 < len AS forced_ending FROM pieces))"""


@query("stream_sliding_queue", sql(PIECES + """
, ends AS (SELECT date_trunc('millisecond', max(created_time)) - INTERVAL 2 HOUR AS seen FROM m2),
after AS (SELECT *, lead(start_time) OVER (PARTITION BY channel_url ORDER BY case_index) AS next FROM queued)
SELECT a.*  EXCLUDE (next), next IS NULL OR next >= seen OR next - end_time >= INTERVAL 30 HOUR AS idle
FROM after a, ends WHERE next < seen OR end_time + INTERVAL 30 HOUR < seen""", "m2_seg"))
def stream_sliding_queue(spark, sf):
    """Cases that the event stream gives away by itself: finished by the next one, or silent for 30 hours at its end."""
    for name, value in queue.STATE_STORE.items():
        spark.conf.set(name, value)
    return drained(spark, queue.stream_cases(in_time_order(spark, a.m2(spark, sf), 4), b.M2_RULES, 3, late="2 hours", idle="30 hours"))


@query("stream_queue_tables", sql(PIECES + " SELECT * FROM queued", "m2_seg"))
def stream_queue_tables(spark, sf):
    """All cases of the event stream, which comes in four micro-batches; at its end every channel counts as idle."""
    folder = new_path(spark, "queue")
    writer = live.stream_sliding_queue(in_time_order(spark, a.m2(spark, sf), 4), folder, b.M2_RULES, 3)
    finish(spark, writer)
    return live.finished_cases(spark, folder, idle="0 seconds")
