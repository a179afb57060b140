"""Review of cases: verdicts, splits, and the loop over rounds."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from convocases.operators import blocks
from convocases.operators.blocks import ROWS_PER_BLOCK, Step, join_spread
from convocases.operators.cases import CASE
from convocases.operators.replies import first_good_reply, validate_review
from convocases.sources.scratch import checkpointed

# Length of the old summary kept in a split's summary, and the number of rounds.
SUMMARY_KEPT, MAX_ROUNDS = 60, 3


def read_reviews(replies: DataFrame) -> DataFrame:
    """One verdict per case from its valid replies: several parts of a long case are put together."""
    good = validate_review(first_good_reply(replies).where(F.col("error").isNull())).where(F.col("reason").isNull())
    return good.groupBy(*CASE).agg(
        F.max("needs_split").alias("needs_split"),
        F.min("review_confidence").alias("review_confidence"),
        F.min_by("reasoning", "request_id").alias("reasoning"),
        F.flatten(F.collect_list(F.when(F.col("needs_split"), F.col("points")))).alias("points"),
    )


def review_lookup(boundaries: DataFrame, reviews: DataFrame) -> DataFrame:
    """Cases with their verdict, where there is one."""
    return boundaries.join(reviews, CASE, "left")


def apply_splits(boundaries: DataFrame, reviews: DataFrame, split_convention: str = "before") -> DataFrame:
    """Cut flagged cases at their points; the rest stay, and `case_index, piece` keeps the order.

    Points count from 1 inside the case; those outside it are ignored. A cut goes before the named message
    (`split_convention='after'`: behind it).
    """
    if split_convention not in ("before", "after"):
        raise ValueError("split_convention must be 'before' or 'after'")
    shift = 1 if split_convention == "before" else 0
    rows = review_lookup(boundaries, reviews.select(*CASE, "needs_split", "review_confidence", "points"))
    start = F.col("start_pos") - 1
    inside = F.filter(F.coalesce("points", F.array().cast("array<bigint>")),
                      lambda p: (p > 0) & (p <= F.col("end_pos") - start))
    points = F.transform(inside, lambda p: start + p - shift)
    split = F.coalesce(F.col("needs_split"), F.lit(False)) & (F.size(points) > 0)
    edges = F.array_sort(F.array_distinct(F.concat(F.array(start), points, F.array(F.col("end_pos")))))
    rows = rows.withColumns({"_edges": edges, "_split": split})
    ranges = F.transform(
        F.sequence(F.lit(1), F.size("_edges") - 1),
        lambda i: F.struct((F.element_at("_edges", i) + 1).alias("start_pos"),
                           F.element_at("_edges", i + 1).alias("end_pos")),
    )
    whole = F.array(F.struct("start_pos", "end_pos"))
    kept = [c for c in boundaries.columns if c not in ("start_pos", "end_pos", "summary", "confidence")]
    pieces = rows.withColumn("_ranges", F.when(F.col("_split"), ranges).otherwise(whole)).select(
        *kept, "summary", "confidence", "review_confidence", "_split", F.posexplode("_ranges").alias("piece", "_range")
    )
    text = F.format_string(
        "Reviewed case split %d from original case %d: %s...",
        F.col("piece") + 1, F.col("case_index"), F.substring(F.coalesce("summary", F.lit("No summary")), 1, SUMMARY_KEPT),
    )
    lower = F.least("confidence", "review_confidence")
    return pieces.select(
        *kept, "piece", "_range.start_pos", "_range.end_pos",
        F.when(F.col("_split"), text).otherwise(F.col("summary")).alias("summary"),
        F.when(F.col("_split"), lower).otherwise(F.col("confidence")).alias("confidence"),
    )


def renumber(pieces: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Dense `case_index` from 0 inside each channel, in the order of `case_index, piece`."""
    o = blocks.in_blocks(pieces, ["channel_url"], ["case_index", "piece"], rows_per_block=rows_per_block)
    numbered = blocks.finish(blocks.scan(o, _n=Step("row_number")))
    return numbered.withColumn("case_index", F.col("_n") - 1).drop("_n", "piece")


def review_loop(
    boundaries: DataFrame, ask: Callable[[DataFrame, int], DataFrame], max_rounds: int = MAX_ROUNDS,
    split_convention: str = "before",
) -> tuple[DataFrame, DataFrame]:
    """Up to `max_rounds` of review and split. Returns the refined boundaries and counters per channel.

    `ask(boundaries, round)` gives review replies (`request_id, channel_url, case_index, content, error`)
    for the channels still open. A channel is done after a round in which none of its cases was flagged.
    Each round is checkpointed, so calls behind `ask` are not made again.
    """
    open_cases, done, counters = boundaries, None, None
    for round_no in range(max_rounds):
        reviews = checkpointed(read_reviews(ask(open_cases, round_no)))
        per_channel = reviews.groupBy("channel_url").agg(
            F.count(F.lit(1)).alias("reviewed"), F.sum(F.col("needs_split").cast("long")).alias("flagged")
        )
        per_channel = open_cases.select("channel_url").distinct().join(per_channel, ["channel_url"], "left")
        flagged = F.coalesce(F.col("flagged"), F.lit(0))
        this_round = checkpointed(per_channel.select(
            "channel_url",
            F.when(flagged > 0, round_no + 1).otherwise(round_no).alias("review_iterations"),
            F.when(flagged > 0, F.col("reviewed")).otherwise(0).alias("cases_reviewed"),
            flagged.alias("cases_split"),
        ))
        counters = this_round if counters is None else counters.unionByName(this_round)
        again = this_round.where(F.col("cases_split") > 0).select("channel_url")
        finished = this_round.where(F.col("cases_split") == 0).select("channel_url")
        closed = join_spread(open_cases, finished, ["channel_url"], "left_semi")
        done = closed if done is None else done.unionByName(closed)
        if again.isEmpty():
            open_cases = None
            break
        active = join_spread(open_cases, again, ["channel_url"], "left_semi")
        open_cases = checkpointed(renumber(apply_splits(active, reviews, split_convention)))
    if open_cases is not None:
        done = open_cases if done is None else done.unionByName(open_cases)
    totals = counters.groupBy("channel_url").agg(
        F.max("review_iterations").alias("review_iterations"),
        F.sum("cases_reviewed").alias("cases_reviewed"), F.sum("cases_split").alias("cases_split"),
    )
    return done, totals
