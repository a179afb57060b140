"""Deterministic case boundaries: time gaps, reference numbers, transition phrases, forced cuts."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Step
from convocases.operators.messages import drop_untimed, in_channel_order
from convocases.operators.stats import side_by_side

REF_PATTERN = r"(?i)\b(?:order|ticket|tracking|case)\s*(?:number|no\.?|#)?\s*(\d+)"
CUE_PATTERN = r"(?i)\b(another question|by the way|new issue|different (?:order|item|issue)|separately|also,)"
SESSION_HOURS, DAY_HOURS = 4, 24


class Rules(NamedTuple):
    ref_pattern: str = REF_PATTERN
    cue_pattern: str = CUE_PATTERN
    session_hours: float = SESSION_HOURS
    day_hours: float = DAY_HOURS
    depth: float | None = None  # with a column `depth`: least fall of coherence that opens a case


def first_match(text: Column, pattern: str) -> Column:
    """First group of the first match (whole match without a group), null without one."""
    group = 1 if "(" in pattern.replace("(?", "").replace(r"\(", "") else 0
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def gap_minutes(now: Column, before: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(before)) / 6e7


def time_gaps(messages: DataFrame, cuts: Cuts | None = None, rules: Rules = Rules()) -> DataFrame:
    """Gap to the previous message of the channel, its class, and whether the calendar day changed."""
    o = in_channel_order(drop_untimed(messages), cuts)
    o = blocks.scan(o, previous_time=Step("lag", F.col("created_time")))
    gap = gap_minutes(F.col("created_time"), F.col("previous_time"))
    gap_class = (
        F.when(gap.isNull(), "first")
        .when(gap <= rules.session_hours * 60, "session")
        .when(gap <= rules.day_hours * 60, "same_day_range")
        .otherwise("long")
    )
    other_day = F.coalesce(F.to_date("created_time") != F.to_date("previous_time"), F.lit(False))
    return blocks.finish(o).withColumns({"gap_minutes": gap, "gap_class": gap_class, "crosses_day": other_day})


def opening(rules: Rules) -> dict[str, Column]:
    """Rule number and confidence of the boundary a message opens; null where it opens none."""
    gap = gap_minutes(F.col("created_time"), F.col("previous_time"))
    both = F.col("ref").isNotNull() & F.col("previous_ref").isNotNull()
    changed = both & (F.col("ref") != F.col("previous_ref"))
    same = both & (F.col("ref") == F.col("previous_ref"))
    cue = F.coalesce(F.col("message").rlike(rules.cue_pattern), F.lit(False))
    other_day = F.to_date("created_time") != F.to_date("previous_time")
    session, day = rules.session_hours * 60, rules.day_hours * 60
    # The first line that holds opens a case: rule number, condition, confidence.
    lines = (
        (1, F.col("previous_time").isNull(), 0.9),
        (2, changed, 0.9),
        (3, (gap > day) & ~same, 0.8),
        (4, (gap > session) & (gap <= day) & ~same & (cue | other_day), 0.6),
        (5, (gap <= session) & cue & ~same, 0.5),
    )
    if rules.depth is not None:
        lines += ((6, F.coalesce(F.col("depth") >= rules.depth, F.lit(False)) & ~same, 0.4),)
    rule, confidence = F.lit(None).cast("int"), F.lit(None).cast("double")
    for number, holds, score in reversed(lines):
        rule = F.when(holds, number).otherwise(rule)
        confidence = F.when(F.col("rule") == number, score).otherwise(confidence)
    return {"rule": rule, "boundary_confidence": confidence}


def segment_by_rules(messages: DataFrame, cuts: Cuts | None = None, rules: Rules = Rules()) -> DataFrame:
    """Messages with `pos`, `channel_seq`, the rule that opens a case, and the case's `case_index` (from 0).

    With `rules.depth`, messages that carry a `depth` (of `context.coherence_depth`) also open a case where it is as large.
    Both scans run on one exchange by channel (and block).
    """
    o = in_channel_order(drop_untimed(messages), cuts)
    o = o._replace(rows=o.rows.withColumn("ref", first_match(F.col("message"), rules.ref_pattern)))
    o = blocks.scan(
        o, pos=Step("row_number"), previous_time=Step("lag", F.col("created_time")),
        previous_ref=Step("last", F.col("ref")), channel_seq=Step("least", F.col("ingest_seq")),
    )
    for name, column in opening(rules).items():
        o = o._replace(rows=o.rows.withColumn(name, column))
    opens = F.col("rule").isNotNull().cast("long")
    o = blocks.scan(o, _opened=Step("sum", opens))
    rows = blocks.finish(o).withColumn("case_index", F.col("_opened") - 1)
    return rows.drop("_opened", "ref", "previous_ref", "previous_time")


def force_boundaries(segmented: DataFrame, max_queue_size: int, cuts: Cuts | None = None) -> DataFrame:
    """Cut every segment after each `max_queue_size` messages.

    Takes the rows of `segment_by_rules`; renumbers `case_index` and flags the pieces that end or start
    at a forced cut.
    """
    o = in_channel_order(segmented, cuts)
    start = F.when(F.col("rule").isNotNull(), F.col("pos"))
    o = blocks.scan(o, _start=Step("max", start), _opened_with=Step("last", F.col("boundary_confidence")))
    in_segment = F.col("pos") - F.col("_start")
    piece_start = (in_segment % max_queue_size) == 0
    o = o._replace(rows=o.rows.withColumns({
        "forced_starting": F.floor(in_segment / max_queue_size) > 0,
        "boundary_confidence": F.coalesce("boundary_confidence", "_opened_with"),
        "_opens": piece_start.cast("long"),
    }))
    o = blocks.scan(o, _pieces=Step("sum", F.col("_opens")))
    rows = blocks.finish(o).withColumns({
        "segment_index": F.col("case_index"), "case_index": F.col("_pieces") - 1,
    })
    return rows.drop("_start", "_opened_with", "_opens", "_pieces")


def compare_segmentations(
    a: DataFrame, b: DataFrame, replies_a: DataFrame | None = None, replies_b: DataFrame | None = None
) -> DataFrame:
    """Two sets of cases over the same messages, side by side, with agreement of their cut points.

    Takes case tables with `channel_url, start_pos, end_pos, confidence`; a cut point is the start of a
    case other than at position 1. Precision and recall are those of `b` against `a`. The tokens are those
    of the replies behind each side, 0 for rules.
    """
    def points(cases, flag):
        starts = cases.where(F.col("start_pos") > 1).select("channel_url", "start_pos").distinct()
        return starts.withColumn(flag, F.lit(1))

    def totals(cases, side):
        return cases.agg(
            F.count(F.lit(1)).alias(f"cases_{side}"), F.avg("confidence").alias(f"avg_confidence_{side}")
        )

    both = points(a, "in_a").join(points(b, "in_b"), ["channel_url", "start_pos"], "full_outer")
    agreement = both.agg(
        F.count("in_a").alias("cuts_a"),
        F.count("in_b").alias("cuts_b"),
        F.count(F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), 1)).alias("cuts_both"),
    )
    def tokens(replies, side):
        spent = F.coalesce(F.sum(F.col("input_tokens") + F.col("output_tokens")), F.lit(0)).cast("long")
        return replies.agg(spent.alias(f"tokens_{side}"))

    asked = [tokens(r, side) for r, side in ((replies_a, "a"), (replies_b, "b")) if r is not None]
    row = side_by_side(totals(a, "a"), totals(b, "b"), agreement, *asked)
    free = {f"tokens_{side}": F.lit(0).cast("long") for side in "ab" if f"tokens_{side}" not in row.columns}
    row = row.withColumns(free) if free else row
    return row.withColumns({
        "precision": F.try_divide("cuts_both", "cuts_b"),
        "recall": F.try_divide("cuts_both", "cuts_a"),
    })
