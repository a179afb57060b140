"""Cases: ranges to messages, numbering, case rows, labels on messages."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from convocases.functions import text
from convocases.operators import blocks, intervals
from convocases.operators.blocks import ROWS_PER_BLOCK, Step, join_spread
from convocases.sources.scratch import checkpointed

CASE = ["channel_url", "case_index"]
PIECE, BUCKET = 65_536, 64
NUMBER_ORDER = ["channel_seq", "channel_url", "case_index"]
HEAD_MESSAGES = 10
CASES_PER_BLOCK = 500_000
#: Up to so many ranges may be smaller than that.
SMALL_RANGES = 200

# Case columns of a message without a case.
CASE_DEFAULTS = {
    "case_number": "''",
    "case_start_time": "cast(null as timestamp)",
    "case_end_time": "cast(null as timestamp)",
    "case_duration_minutes": "0.0D",
    "case_confidence": "0.0D",
    "case_summary": "''",
    "case_forced_ending": "false",
    "case_forced_starting": "false",
    "case_truncated": "false",
}


def position_buckets(ranges: DataFrame) -> DataFrame:
    """One row per (range, bucket of positions) it touches.

    In two steps, so that no row holds a long list: pieces first, dealt out anew, then the buckets of each.
    """
    pieces = ranges.withColumn(
        "_piece", F.explode(F.sequence(F.floor(F.col("start_pos") / PIECE), F.floor(F.col("end_pos") / PIECE)))
    ).repartition("channel_url", "_piece")
    low = F.greatest(F.col("start_pos"), F.col("_piece") * PIECE)
    high = F.least(F.col("end_pos"), F.col("_piece") * PIECE + PIECE - 1)
    buckets = F.explode(F.sequence(F.floor(low / BUCKET), F.floor(high / BUCKET)))
    return pieces.withColumn("_bucket", buckets).drop("_piece")


def cases_to_messages_range(ranges: DataFrame, positioned: DataFrame) -> DataFrame:
    """Every case range with its messages, both ends included.

    An equi-join on (channel, bucket of 64 positions) with the exact range as a further condition: no
    channel or case meets in one task, and a bucket holds at most 64 messages. No side is broadcast: a range becomes many
    rows, which Spark's estimate of its size does not know.
    """
    kept = [c for c in ranges.columns if c not in positioned.columns or c == "channel_url"]
    left = position_buckets(ranges.select(*dict.fromkeys([*kept, "start_pos", "end_pos"])))
    right = positioned.withColumn("_bucket", F.floor(F.col("pos") / BUCKET))
    joined = right.join(left.hint("merge"), ["channel_url", "_bucket"])
    return joined.where(F.col("pos").between(F.col("start_pos"), F.col("end_pos"))).drop("_bucket")


def build_cases(case_messages: DataFrame, extra: dict[str, tuple[Callable, str]] | None = None) -> DataFrame:
    """One row per case from its messages (rows with `case_index`).

    Participants are gathered as sets, in the tasks that read the messages first, so a task hands on one row for each of
    its cases. `extra` names further columns, each an aggregate and its source.
    """
    extra = extra or {}
    cases = case_messages.groupBy(*CASE).agg(
        F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"),
        F.min("created_time").alias("start_time"), F.max("created_time").alias("end_time"),
        F.count("pos").alias("n_messages"),
        F.sort_array(F.collect_set("sender_id")).alias("participants"),
        *(agg(source).alias(name) for name, (agg, source) in extra.items()),
    )
    return cases.withColumns({
        "duration_minutes": text.minutes_between(F.col("start_time"), F.col("end_time")),
        **{flag: F.lit(False) for flag in ("forced_ending", "forced_starting") if flag not in cases.columns},
    })


def with_summary(cases: DataFrame) -> DataFrame:
    """An empty or absent summary becomes a count of the messages."""
    given = F.col("summary") if "summary" in cases.columns else F.lit(None).cast("string")
    count = F.format_string("Support case with %d messages", F.col("n_messages"))
    return cases.withColumn("summary", F.when(F.coalesce(given, F.lit("")) == "", count).otherwise(given))


def forced_endings(pieces: DataFrame) -> DataFrame:
    """Flag a piece whose successor starts at a forced cut. Works on the piece table of one row per case."""
    follower = pieces.where(F.col("forced_starting")).select(
        "channel_url", (F.col("case_index") - 1).alias("case_index"), F.lit(True).alias("_forced")
    )
    joined = pieces.join(follower.hint("merge"), ["channel_url", "case_index"], "left")
    return joined.withColumn("forced_ending", F.coalesce(F.col("_forced"), F.lit(False))).drop("_forced")


def cases_of_segments(segmented: DataFrame) -> DataFrame:
    """Cases of rule-segmented messages; a case has the confidence of the boundary that opens it."""
    extra = {"channel_seq": (F.min, "channel_seq"), "confidence": (F.max, "boundary_confidence")}
    if "forced_starting" in segmented.columns:
        extra["forced_starting"] = (F.max, "forced_starting")
    cases = with_summary(build_cases(segmented, extra))
    return forced_endings(cases.drop("forced_ending")) if "forced_starting" in extra else cases


def cases_of_boundaries(boundaries: DataFrame, positioned: DataFrame) -> DataFrame:
    """Cases of accepted boundary rows (`start_pos`, `end_pos`, `summary`, `confidence`, `channel_seq`).

    Ranges that share no message meet theirs in order, in one exchange by channel. Else they are joined with the messages;
    the texts stay out of that join and come back by case.
    """
    ranges = boundaries.select(*CASE, "start_pos", "end_pos")
    held = positioned.select("channel_url", "pos", "created_time", "sender_id")
    given = [c for c in ("case_truncated", "forced_ending", "forced_starting") if c in boundaries.columns]
    labels = boundaries.select(*CASE, "channel_seq", "summary", "confidence", *given)
    if intervals.reached_over(ranges).isEmpty():
        return with_summary(cases_in_order(boundaries, held, labels.columns[len(CASE):]))
    rows = cases_to_messages_range(ranges, held)
    return with_summary(build_cases(rows, {}).drop(*given).join(labels.hint("merge"), CASE))


def cases_in_order(ranges: DataFrame, messages: DataFrame, labels: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Cases of disjoint ranges (with `labels`) from messages with `pos`.

    A range is a row just before its first message, and a message belongs to the last range that starts at or before it,
    if that reaches it. A scan finds it, in blocks where a channel is too large; no message carries a label.
    """
    starts = ranges.where(F.col("start_pos") <= F.col("end_pos")).select(
        "channel_url", F.col("start_pos").alias("_at"), F.lit(False).alias("_message"), F.struct("case_index", "end_pos", *labels).alias("_range"))
    rows = starts.unionByName(messages.withColumnRenamed("pos", "_at").withColumn("_message", F.lit(True)), allowMissingColumns=True)
    o = blocks.in_blocks(rows, ["channel_url"], ["_at", "_message"], rows_per_block=rows_per_block)
    place = F.when(~F.col("_message"), F.struct("_range.case_index", "_range.end_pos"))
    rows = blocks.finish(blocks.scan(o._replace(rows=o.rows.withColumn("_opens", place)), _open=Step("last", F.col("_opens"))))
    rows = rows.withColumn("_of", F.coalesce("_opens", "_open")).where(F.col("_at") <= F.col("_of.end_pos"))
    rows = rows.withColumns({"case_index": F.col("_of.case_index"), "pos": F.when(F.col("_message"), F.col("_at"))})
    cases = build_cases(rows, {"_range": (F.max, "_range")}).where(F.col("n_messages") > 0)
    return cases.select(*(c for c in cases.columns if c not in labels and c != "_range"), *(f"_range.{c}" for c in labels))


def number_cases(cases: DataFrame, rows_per_block: int = CASES_PER_BLOCK) -> DataFrame:
    """`CASE_0001`... over all channels in ingest order, then by case index; dense and without gaps.

    The cases are dealt into ranges of the order, as many as their number asks for, sorted, and written once with their
    range and place in it; a case's number is its place and the sizes of the ranges before. So a task never holds
    more than a range, and rows move once. Beyond SMALL_RANGES of them, ranges grow up to CASES_PER_BLOCK before there are
    more: a range costs a task and files, and small ones would cost more than their rows.
    """
    count = cases.count()
    ranges = max(1, min(-(-count // rows_per_block), max(SMALL_RANGES, -(-count // CASES_PER_BLOCK))))
    dealt = cases.repartitionByRange(ranges, *NUMBER_ORDER) if ranges > 1 else cases.repartition(1)
    placed = dealt.sortWithinPartitions(*NUMBER_ORDER).withColumn("_n", F.monotonically_increasing_id())
    if ranges == 1:
        return placed.withColumn("case_number", text.case_id(F.col("_n") + 1)).drop("_n")
    # Such an id is the partition's number, then 33 bits of the row's place in it.
    placed = checkpointed(placed.withColumns({"_range": F.shiftright("_n", 33), "_n": F.col("_n").bitwiseAND((1 << 33) - 1) + 1}))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(before), ["_range"])
    return numbered.withColumn("case_number", text.case_id(F.col("_n") + F.col("_before"))).drop("_n", "_before", "_range")


def case_order(number: Column) -> Column:
    """The number inside a case id, so that cases past 9999 compare in order."""
    return F.substring_index(number, "_", -1).cast("long")


def with_case_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.expr(default)) if c in df.columns else F.expr(default)
        for c, default in CASE_DEFAULTS.items()
    })


def assign_cases(messages: DataFrame, cases: DataFrame, positioned: DataFrame) -> DataFrame:
    """Case columns on every message; the last case wins, rows without a case get defaults.

    The match is by (channel, message id), so copies of an id in one channel share its last case. Overlapping ranges
    become disjoint intervals first, so each message meets one number however many cases hold it. Only numbers of cases
    move with the intervals; the texts come in by case at the end, where a hot case is dealt into shares.
    """
    columns = {
        "case_number": "case_number", "start_time": "case_start_time", "end_time": "case_end_time",
        "duration_minutes": "case_duration_minutes", "confidence": "case_confidence", "summary": "case_summary",
        "forced_ending": "case_forced_ending", "forced_starting": "case_forced_starting",
    }
    if "case_truncated" in cases.columns:
        columns["case_truncated"] = "case_truncated"
    nth = case_order(F.col("case_number")).alias("_nth_case")
    ranges = intervals.disjoint(cases.select("channel_url", "start_pos", "end_pos", nth), "_nth_case")
    rows = cases_to_messages_range(ranges, positioned.select("channel_url", "message_id", "pos"))
    last = rows.groupBy("channel_url", "message_id").agg(F.max("_nth_case").alias("_nth_case"))
    left = messages.drop(*CASE_DEFAULTS)
    spread = [c for c in ("ingest_seq", "created_time") if c in left.columns]
    numbered = join_spread(left, last, ["channel_url", "message_id"], spread=spread)
    labels = cases.select(nth, *(F.col(a).alias(b) for a, b in columns.items()))
    length = F.col("end_pos") - F.col("start_pos") + 1  # a case labels no more messages than it spans
    shares = (F.floor(length / ROWS_PER_BLOCK) + 1).cast("int").alias("_shares")
    large = cases.where(length >= ROWS_PER_BLOCK).select(nth, shares).orderBy(F.desc("_shares")).limit(blocks.MAX_CUTS).collect()
    labelled = join_spread(numbered, labels, ["_nth_case"], spread=["message_id", *spread], hot=large)
    return with_case_defaults(labelled.drop("_nth_case"))


def assign_segments(segmented: DataFrame, cases: DataFrame) -> DataFrame:
    """Case columns on rule-segmented messages, by the case index they already carry.

    The join key takes in the million of the position, so one giant case meets in many tasks; a case has
    one row per million it touches. Cases grow with the messages and are never broadcast.
    """
    million = F.lit(1 << 20)
    first, last = (F.floor(F.col(c) / million) for c in ("start_pos", "end_pos"))
    wanted = cases.select(
        *CASE, F.explode(F.sequence(first, last)).alias("_million"),
        "case_number", F.col("start_time").alias("case_start_time"), F.col("end_time").alias("case_end_time"),
        F.col("duration_minutes").alias("case_duration_minutes"), F.col("confidence").alias("case_confidence"),
        F.col("summary").alias("case_summary"), F.col("forced_ending").alias("case_forced_ending"),
        F.col("forced_starting").alias("case_forced_starting"),
    )
    rows = segmented.drop("rule", "boundary_confidence", "forced_starting", "segment_index")
    rows = rows.withColumn("_million", F.floor(F.col("pos") / million))
    return with_case_defaults(rows.join(wanted.hint("merge"), [*CASE, "_million"], "left").drop("_million"))


def assigned_only(df: DataFrame, column: str = "case_number") -> DataFrame:
    return df.where(F.coalesce(F.col(column), F.lit("")) != "")


def distinct_cases(df: DataFrame) -> DataFrame:
    return assigned_only(df).select("case_number").distinct()


def sort_case_messages(labelled: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """`case_pos`: place of each message in its case, by time."""
    order = ["created_time", "ingest_seq", "message_id"]
    o = blocks.in_blocks(assigned_only(labelled), ["case_number"], order, rows_per_block=rows_per_block)
    return blocks.finish(blocks.scan(o, case_pos=Step("row_number")))


def case_head(labelled: DataFrame, n: int = HEAD_MESSAGES) -> DataFrame:
    """First `n` messages of each case and the number left out.

    The rank is limited before the exchange, so at most `n` rows per case and task move; the count is a
    separate pre-aggregated pass, joined to rows that are bounded per case.
    """
    rows = assigned_only(labelled)
    rank = F.row_number().over(Window.partitionBy("case_number").orderBy("created_time", "ingest_seq", "message_id"))
    head = rows.withColumn("case_pos", rank).where(F.col("case_pos") <= n)
    counts = rows.groupBy("case_number").agg(F.count(F.lit(1)).alias("_n"))
    left_out = F.greatest(F.col("_n") - n, F.lit(0)).alias("remaining")
    return head.join(counts, ["case_number"]).select(*head.columns, left_out)
