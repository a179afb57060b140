"""Cases across the borders of overlapping request parts: each border is decided in the middle of what both parts saw."""

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Ordered, Step
from convocases.operators.replies import _channel, fallback_of_part, proposals, reject_reason
from convocases.sources.scratch import checkpointed


def seams(o: Ordered) -> Ordered:
    """Parts (`first_pos, last_pos`) in order with `own_from, own_to`, the positions they decide, and `blind`.

    Two neighbours share the messages from the later part's first to the earlier one's last; the seam lies behind the
    middle one of these. Where they share nothing it lies at the earlier part's end, and the later part is `blind`: it
    did not see what was before.
    """
    def seam(first: Column, before: Column) -> Column:
        return F.when(first <= before, F.floor((first + before) / 2)).otherwise(before)

    o = blocks.scan(o, _before=Step("lag", F.col("last_pos")), _after=Step("lead", F.col("first_pos")))
    first, last, before, after = (F.col(c) for c in ("first_pos", "last_pos", "_before", "_after"))
    rows = o.rows.withColumns({
        "own_from": F.coalesce(F.when(before.isNotNull(), seam(first, before) + 1), first),
        "own_to": F.coalesce(F.when(after.isNotNull(), seam(after, last)), last),
        "blind": F.coalesce(first > before, F.lit(False)),
    })
    return o._replace(rows=rows.drop("_before", "_after"))


def _within(ranges: Column, low: Column, high: Column) -> Column:
    """The ranges that start and end at either side of two positions or between them, as far as they lie there."""
    some = F.filter(ranges, lambda c: (c["end_pos"] >= low) & (c["start_pos"] <= high))
    return F.transform(some, lambda c: F.struct(
        c["index"].alias("index"), F.greatest(c["start_pos"], low).alias("start_pos"), F.least(c["end_pos"], high).alias("end_pos"),
        c["summary"].alias("summary"), c["confidence"].alias("confidence")))


def ranges_of_parts() -> Column:
    """The valid ranges of a checked reply, or the fallback, as far as the part's messages go."""
    listed = F.when(F.col("status") == "ok", proposals(F.lit(0))).otherwise(fallback_of_part())
    valid = F.filter(listed, lambda c: reject_reason(c["start_pos"], c["end_pos"], c["confidence"]).isNull())
    return _within(F.transform(valid, lambda c: F.struct(
        c["case_index"].alias("index"), *(c[name].alias(name) for name in ("start_pos", "end_pos", "summary", "confidence")),
    )), F.col("first_pos"), F.col("last_pos"))


def _across(at: str, score) -> Column:
    """The last range of a part that holds a position, with what has to be known of it."""
    held = F.filter("ranges", lambda c: (c["start_pos"] <= F.col(at)) & (F.col(at) <= c["end_pos"]))
    return F.array_max(F.transform(held, lambda c: F.struct(c["index"].alias("index"), score(c).alias("open"), F.col("fallback").alias("fallback"))))


def _of_cases(cuts: Cuts) -> Cuts:
    """Cuts of parts as cuts of the cases, by the part and place in which a case first occurs."""
    rows = [Row(channel_url=r["channel_url"], _part=r["part"], _index=-1) for r in cuts.rows]
    part = T.StructField("_part", cuts.schema["part"].dataType)
    return Cuts(rows, T.StructType([cuts.schema["channel_url"], part, T.StructField("_index", T.LongType())]))


def stitched(joined: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Boundary rows of whole channels from the checked replies (of `join_replies`) to overlapping parts.

    A part decides the positions nearest to its own middle, up to the seams; its ranges are cut there. The range on one
    side of a seam and the one on the other are one case if they share messages: the earlier one reaches over the seam,
    or to the end of its part, and the later one starts at or before it. A case may so go on over any number of parts.
    A cut that no reply asked for stays where neighbours share no message, or where one of them has no usable reply; it
    is flagged by `forced_ending` and `forced_starting`. Parts without usable reply that follow each other are one case.

    Summary and confidence of a case are those of its longest piece, of equal ones the first. Case numbers are dense in a
    channel, by the part and place in which a case first occurs. One row for each part moves, once, by channel, with the
    ranges of its reply; what follows is done where it lies, without a join. `cuts` are those of the parts, by `part`;
    only rows of channels cut into blocks move on, and are written first.
    """
    channel = _channel(joined)
    cuts = blocks.find_cuts(joined, ["channel_url"], ["part"]) if cuts is None else cuts
    parts = joined.select(
        *channel, "part", "first_pos", "last_pos", (F.col("status") != "ok").alias("fallback"), ranges_of_parts().alias("ranges"))
    o = seams(blocks.in_blocks(checkpointed(parts) if cuts.rows else parts, ["channel_url"], ["part"], cuts))

    # What stands at both ends of each part's own positions.
    o = o._replace(rows=o.rows.withColumns({
        "_right": _across("own_to", lambda c: (c["end_pos"] > F.col("own_to")) | (c["end_pos"] == F.col("last_pos"))),
        "_left": _across("own_from", lambda c: c["start_pos"] < F.col("own_from")),
    }))
    o = blocks.scan(o, _before=Step("lag", F.col("_right")))
    both = F.col("_before").isNotNull() & F.col("_left").isNotNull()
    same_kind = F.col("_before.fallback") == F.col("_left.fallback")
    agreed = (F.col("_before.open") & F.col("_left.open")) | F.col("_left.fallback")  # a fallback has nothing to agree on
    linked = F.coalesce(both & same_kind & agreed & (~F.col("blind") | F.col("_left.fallback")), F.lit(False))
    forced = F.coalesce(both & ~linked & (F.col("blind") | ~same_kind), F.lit(False))
    through = F.coalesce(F.col("_left.index") == F.col("_right.index"), F.lit(False))
    o = o._replace(rows=o.rows.withColumns({"_linked": linked, "_forced": forced}))
    # A chain starts at a part whose right range does not come from its left; later parts of the chain know it by that part.
    o = blocks.scan(o, _starts=Step("max", F.when(~(F.col("_linked") & through), F.col("part"))))
    o = blocks.scan(o, _chain=Step("lag", F.col("_starts")))

    pieces = blocks.finish(o).select(
        *channel, "part", "own_from", "_linked", "_forced", "_chain", "_starts", F.col("_left.index").alias("_left"),
        F.col("_right.index").alias("_right"), F.inline(_within(F.col("ranges"), F.col("own_from"), F.col("own_to"))))
    goes_on = F.col("_linked") & (F.col("index") == F.col("_left"))
    pieces = pieces.withColumns({
        "_group": F.when(goes_on, F.col("_chain")).when(F.col("index") == F.col("_right"), F.col("_starts")),
        "_alone": F.when(~(goes_on | F.coalesce(F.col("index") == F.col("_right"), F.lit(False))), F.struct("part", "index")),
        "_starting": F.col("_forced") & (F.col("index") == F.col("_left")) & (F.col("start_pos") == F.col("own_from")),
        "_length": F.col("end_pos") - F.col("start_pos") + 1,
    })
    best = F.max_by(F.struct("summary", "confidence"), F.struct(F.col("_length"), -F.col("part")))
    cases = pieces.groupBy(*channel, "_group", "_alone").agg(
        F.min(F.struct("part", "index")).alias("_at"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"),
        best.alias("_best"), F.min_by("_starting", "part").alias("forced_starting"),
    )
    # The case before a forced cut ends there: the cut meets it as a row of its own.
    cut = F.when(F.col("forced_starting"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    cases = cases.withColumn("_cut", F.explode(cut))
    cases = cases.withColumn("_border", F.when(F.col("_cut"), F.col("start_pos")).otherwise(F.col("end_pos") + 1))
    cases = cases.withColumn("forced_ending", F.max("_cut").over(Window.partitionBy("channel_url", "_border"))).where(~F.col("_cut"))
    cases = cases.withColumns({"_part": F.col("_at.part"), "_index": F.col("_at.index")})
    o = blocks.in_blocks(cases, ["channel_url"], ["_part", "_index"], _of_cases(cuts))
    rows = blocks.finish(blocks.scan(o, case_index=Step("row_number")))
    return rows.select(
        *channel, (F.col("case_index") - 1).alias("case_index"), "start_pos", "end_pos", "_best.summary", "_best.confidence",
        "forced_ending", F.coalesce("forced_starting", F.lit(False)).alias("forced_starting"))
