"""The stages put together: clean, segment, review, classify."""

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from convocases.functions.text import parse_created_time
from convocases.operators import cases as case_ops, classify, replies as reply_ops, reports, segment, stats, stitch
from convocases.operators.blocks import Cuts, find_cuts
from convocases.operators.channels import channel_counts, filter_channels
from convocases.operators.messages import clean_messages, drop_untimed, message_cuts, message_positions
from convocases.operators.review import review_loop
from convocases.operators.segment import Rules
from convocases.operators.taxonomy import taxonomy_table
from convocases.plans import requests as request_ops
from convocases.sources.scratch import DENSE, checkpointed


class Segmented(NamedTuple):
    messages: DataFrame
    cases: DataFrame
    reviews: DataFrame | None = None  # counters per channel, if there was a review


class Run(NamedTuple):
    messages: DataFrame
    cases: DataFrame | None
    classifications: DataFrame | None
    reviews: DataFrame | None = None


class Results(NamedTuple):
    channels: DataFrame
    totals: DataFrame
    segmentation: DataFrame
    classification: DataFrame | None


def segmented_rows(
    messages: DataFrame, rules: Rules = Rules(), max_queue_size: int | None = None, cuts: Cuts | None = None
) -> DataFrame:
    cuts = message_cuts(messages.where(F.col("created_time").isNotNull())) if cuts is None else cuts
    rows = segment.segment_by_rules(messages, cuts, rules)
    return segment.force_boundaries(rows, max_queue_size, cuts) if max_queue_size else rows


def rule_cases(messages: DataFrame, rules: Rules = Rules(), **options) -> DataFrame:
    """Numbered cases by the deterministic rules. Only the case table is written on the way."""
    cases = case_ops.cases_of_segments(segmented_rows(messages, rules, **options))
    return case_ops.number_cases(checkpointed(cases))


def segment_with_rules(
    messages: DataFrame, rules: Rules = Rules(), max_queue_size: int | None = None, cuts: Cuts | None = None
) -> Segmented:
    """Cases by the deterministic rules, on every timed message.

    Rows and cases are written once: building, numbering and assigning the cases all read them.
    """
    rows = checkpointed(segmented_rows(messages, rules, max_queue_size, cuts), **DENSE)
    cases = case_ops.number_cases(checkpointed(case_ops.cases_of_segments(rows)))
    return Segmented(case_ops.assign_segments(rows, cases), cases)


def segment_with_boundaries(messages: DataFrame, boundaries: DataFrame, positioned: DataFrame) -> Segmented:
    """Cases of checked boundary rows, numbered and put on the messages; untimed messages stay unassigned."""
    cases = case_ops.number_cases(checkpointed(case_ops.cases_of_boundaries(boundaries, positioned)))
    return Segmented(case_ops.assign_cases(messages, cases, positioned), cases)


def segment_with_replies(
    messages: DataFrame, replies: DataFrame, review: Callable[[DataFrame, int], DataFrame] | None = None,
    cuts: Cuts | None = None, requests: DataFrame | None = None,
) -> Segmented:
    """Replies to boundaries (with fallbacks), range check, optional review rounds, cases, assignment.

    Hand in the written `requests` the replies belong to, to spare building them again. Replies to requests with an
    overlap are stitched, so that the borders of parts cut no case. The positions,
    without the texts, are written once: case building and assignment both read them.
    """
    cuts = message_cuts(messages.where(F.col("created_time").isNotNull())) if cuts is None else cuts
    places = message_positions(messages, cuts)
    positioned = checkpointed(places.select("channel_url", "message_id", "pos", "created_time", "sender_id"), **DENSE)
    requests = request_ops.segmentation_requests(messages, cuts) if requests is None else requests
    if "overlap" in requests.columns:
        part_cuts = find_cuts(requests, ["channel_url"], ["part"])
        boundaries = checkpointed(stitch.stitched(reply_ops.join_replies(requests, replies), part_cuts))
    else:
        boundaries = reply_ops.valid_ranges(reply_ops.boundaries_of_replies(requests, replies))
    reviews = None
    if review is not None:
        boundaries, reviews = review_loop(boundaries, review)
    return segment_with_boundaries(messages, boundaries, positioned)._replace(reviews=reviews)


def classify_with_replies(
    labelled: DataFrame, replies: DataFrame, taxonomy: DataFrame | None = None,
    classified_at: Column | None = None, requests: DataFrame | None = None,
) -> DataFrame:
    """Labelled messages with category columns from the replies; unclassified rows keep defaults."""
    taxonomy = taxonomy_table(labelled.sparkSession) if taxonomy is None else taxonomy
    requests = request_ops.classification_requests(labelled, taxonomy) if requests is None else requests
    found = classify.classifications_of_replies(requests, replies, taxonomy, classified_at)
    return classify.assign_categories(labelled, found)


def rule_classifications(
    labelled: DataFrame, taxonomy: DataFrame | None = None, classified_at: Column | None = None
) -> DataFrame:
    taxonomy = taxonomy_table(labelled.sparkSession) if taxonomy is None else taxonomy
    at = F.current_timestamp() if classified_at is None else classified_at
    found = classify.classify_by_rules(labelled, taxonomy)
    return found.select(
        "case_number", "category", "confidence", F.lit("word overlap").alias("reasoning"), at.alias("classified_at")
    )


def run_pipeline(
    raw: DataFrame, skip_clean: bool = False, skip_segment: bool = False, skip_classify: bool = False,
    segmentation_replies: DataFrame | None = None, segmentation_requests: DataFrame | None = None,
    classification_replies: DataFrame | None = None, classification_requests: DataFrame | None = None,
    review: Callable[[DataFrame, int], DataFrame] | None = None, taxonomy: DataFrame | None = None,
    rules: Rules = Rules(), classified_at: Column | None = None, channels: DataFrame | Sequence[str] | None = None,
    straighten: bool = False, drop: Sequence[str] = (), max_queue_size: int | None = None,
) -> Run:
    """The whole run. Without replies the deterministic rules segment and classify.

    `channels` selects channels, `drop` message types to leave out, `max_queue_size` forces cuts in long cases. A
    labelled table may run again: its case and category columns are overwritten. A skipped stage leaves its label column as it is, or adds an empty one. Skipping all is refused.
    Later stages read the cleaned and the segmented messages several times, a few columns at a time, so both
    are written as tables on the way, and so are the classifications.
    """
    if skip_clean and skip_segment and skip_classify:
        raise ValueError("all stages skipped")
    reviews = None
    messages = raw if skip_clean else checkpointed(clean_messages(raw, straighten, drop).drop("created_time_raw"))
    if channels is not None:
        messages = filter_channels(messages, channels)
    cases = classifications = None
    if skip_segment:
        if "case_number" not in messages.columns:
            messages = messages.withColumn("case_number", F.lit(""))
    else:
        if dict(messages.dtypes)["created_time"] == "string":
            messages = messages.withColumn("created_time", parse_created_time(F.col("created_time")))
        messages = messages.drop(*case_ops.CASE_DEFAULTS)
        untimed = messages.where(F.col("created_time").isNull())
        timed = drop_untimed(messages)
        if segmentation_replies is None:
            done = segment_with_rules(timed, rules, max_queue_size)
        else:
            done = segment_with_replies(timed, segmentation_replies, review, requests=segmentation_requests)
        labelled = done.messages.select(*messages.columns, *case_ops.CASE_DEFAULTS)
        messages, cases = labelled.unionByName(case_ops.with_case_defaults(untimed)), done.cases
        reviews = done.reviews
    if skip_classify:
        if "category" not in messages.columns:
            messages = messages.withColumn("category", F.lit(""))
    else:
        taxonomy = taxonomy_table(raw.sparkSession) if taxonomy is None else taxonomy
        if not skip_segment:
            messages = checkpointed(messages)
        if classification_replies is None:
            found = rule_classifications(messages, taxonomy, classified_at)
        else:
            asked = classification_requests
            asked = request_ops.classification_requests(messages, taxonomy) if asked is None else asked
            found = classify.classifications_of_replies(asked, classification_replies, taxonomy, classified_at)
        classifications = checkpointed(found)
        messages = classify.assign_categories(messages, classifications)
    return Run(messages, cases, classifications, reviews)


def results(run: Run, replies: DataFrame | None = None) -> Results:
    """Statistics per channel and in all, and both reports, of a run that segmented.

    `replies` are all replies that were paid for, those of reviews too: `channel_url`, the columns of their costs, and
    `error`. Review counters come from the run.
    """
    if run.cases is None:
        raise ValueError("the run did not segment")
    if replies is None:
        replies = run.messages.sparkSession.createDataFrame([], "channel_url string, " + request_ops.REPLY_SCHEMA)
    channels = checkpointed(stats.channel_stats(channel_counts(run.messages), run.cases, replies, run.reviews))
    return Results(
        channels, stats.total_stats(channels), reports.segmentation_report(run.cases, channels),
        None if run.classifications is None else reports.classification_report(run.classifications),
    )


