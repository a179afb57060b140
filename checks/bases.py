"""Tables that several queries start from, written once per session and folder."""

from functools import wraps

from pyspark.sql import functions as F

from checks import adapters as a
from convocases.operators import messages as m, replies as r, segment
from convocases.operators.taxonomy import taxonomy_table
from convocases.plans import pipeline, requests
from convocases.sources.scratch import DENSE, checkpointed

M2_RULES = segment.Rules(cue_pattern="^signup$")
M1_RULES = segment.Rules(cue_pattern="^[A-D]")
M3_RULES = segment.Rules(ref_pattern=r"order #(\d+)")
SHORT_RULES = M2_RULES._replace(session_hours=2)
AT = "2024-06-01 12:00:00"
_kept = {}


def once(fn):
    @wraps(fn)
    def get(spark, sf):
        key = (fn.__name__, spark.sparkContext.applicationId, sf)
        if key not in _kept:
            _kept[key] = written(fn(spark, sf))
        return _kept[key]
    return get


def kept(fn):
    """A base whose operators write what is read again: built once, and each query reads of it the columns that it needs."""
    @wraps(fn)
    def get(spark, sf):
        key = (fn.__name__, spark.sparkContext.applicationId, sf)
        if key not in _kept:
            _kept[key] = fn(spark, sf)
        return _kept[key]
    return get


def written(base):
    """The tables of a base, each written once."""
    if isinstance(base, tuple):
        return base._make(None if df is None else checkpointed(df) for df in base)
    return checkpointed(base)


def at():
    return F.lit(AT).cast("timestamp")


@once
def m1_pos(spark, sf):
    return m.message_positions(a.m1(spark, sf, spread=True))


def m1_cleaned(spark, sf):
    """M1 from its written rows: cleaning costs more than all else that is done with a message."""
    return m1_pos(spark, sf).drop("pos")


@once
def m1_requests(spark, sf):
    return requests.segmentation_requests(m1_cleaned(spark, sf))


@once
def boundaries(spark, sf):
    return r.valid_ranges(r.boundaries_of_replies(m1_requests(spark, sf), a.r1_replies(spark, sf)))


@once
def segmented(spark, sf):
    """M1 with R1: labelled messages and numbered cases."""
    return pipeline.segment_with_boundaries(m1_cleaned(spark, sf), boundaries(spark, sf), m1_pos(spark, sf))


@once
def classifications(spark, sf):
    """Accepted R3 classifications of those cases."""
    from convocases.operators.classify import classifications_of_replies
    replies = a.r3_replies(segmented(spark, sf).cases)
    return classifications_of_replies(replies.select("request_id", "case_number"), replies, taxonomy_table(spark), at())


@once
def final(spark, sf):
    from convocases.operators.classify import assign_categories
    return assign_categories(segmented(spark, sf).messages, classifications(spark, sf))


@kept
def m2_rules(spark, sf):
    return pipeline.segment_with_rules(a.m2(spark, sf), M2_RULES)


@kept
def m3_feed(spark, sf):
    """M3 as written rows, for steps that would each tell line items apart and join the orders anew."""
    return checkpointed(a.m3(spark, sf), **DENSE)


@kept
def m3_rules(spark, sf):
    return pipeline.segment_with_rules(m3_feed(spark, sf), M3_RULES)


@once
def m3_seg(spark, sf):
    return segment.segment_by_rules(a.m3(spark, sf), rules=M3_RULES)


@once
def channel_stats(spark, sf):
    from convocases.operators import channels, stats
    return stats.channel_stats(
        channels.channel_counts(a.m1(spark, sf)), segmented(spark, sf).cases, a.r1_replies(spark, sf)
    )


