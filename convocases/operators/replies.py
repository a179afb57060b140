"""Model replies: find the JSON, check it, turn it into boundary rows.

Everything is native expressions on `VARIANT`; a reply that fails a check keeps the reason.
"""

from pyspark.sql import Column, DataFrame, functions as F

from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Step

# Fallback cases and the patterns that find JSON in a reply.
NO_REPLY_SUMMARY, NO_REPLY_CONFIDENCE = "No LLM analysis available - processed as single case", 0.3
FAILED_SUMMARY, FAILED_CONFIDENCE = "LLM analysis failed - processed as single case", 0.1
CASE_KEYS = ("start_message", "end_message", "summary", "confidence")
REVIEW_KEYS = ("needs_split", "confidence", "reasoning")
CLASSIFICATION_KEYS = ("primary_category", "secondary_category", "confidence", "reasoning")
TAGGED = r"(?is)<output>\s*(.*?)\s*</output>"
TAGGED_OBJECT = r"(?is)<output>\s*(\{.*?\})\s*</output>"
FENCED = r"(?is)```(?:json)?\s*(\{.*?\})\s*```"
OUTER_BRACES = r"(?s)\{.*\}"
ONE_LEVEL_OBJECT = r"\{[^{}]*+(?:\{[^{}]*+\}[^{}]*+)*+\}"
PART_ORDER = ["part", "request_id"]


def kind(value: Column) -> Column:
    """Type name of a variant: OBJECT<...>, ARRAY<...>, BIGINT, STRING, BOOLEAN, VOID, ...; null if absent."""
    return F.schema_of_variant(value)


def is_object(json: Column) -> Column:
    """Whether a text is one JSON object and nothing else.

    The parser stops at the end of the first value, so the text is tried inside a list and inside an
    object: what follows a value may end one of the two early, but never both.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), json, F.lit("}")))
    kept = kind(F.try_variant_get(in_object, "$.v", "variant")).startswith("OBJECT")
    return F.coalesce(in_list.isNotNull() & kept, F.lit(False))


def extract_json(content: Column) -> dict[str, Column]:
    """`branch` that found a JSON object in a reply, and `json`, its text.

    Tried in order: whole text, <output> tag, fenced block, first to last brace, longest object with one
    nested level. The first that parses is taken.
    """
    objects = F.filter(F.regexp_extract_all(content, F.lit(ONE_LEVEL_OBJECT), F.lit(0)), is_object)
    longest = F.reduce(objects, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    candidates = {
        "whole": F.trim(content),
        "tag": F.regexp_extract(content, TAGGED, 1),
        "fence": F.regexp_extract(content, FENCED, 1),
        "braces": F.regexp_extract(content, OUTER_BRACES, 0),
    }
    branch = F.when(F.size(objects) > 0, "object")
    found = F.when(longest != "", longest)
    for name, candidate in reversed(candidates.items()):
        branch = F.when(is_object(candidate), name).otherwise(branch)
        found = F.when(is_object(candidate), candidate).otherwise(found)
    return {"branch": branch, "json": found}


def extract_json_classification(content: Column) -> dict[str, Column]:
    """As `extract_json`, for classification: a tagged object, else the first one-level object that parses."""
    tagged = F.regexp_extract(content, TAGGED_OBJECT, 1)
    first = F.get(F.filter(F.regexp_extract_all(content, F.lit(ONE_LEVEL_OBJECT), F.lit(0)), is_object), F.lit(0))
    return {
        "branch": F.when(tagged != "", "tag").when(first.isNotNull(), "object"),
        "json": F.when(tagged != "", tagged).otherwise(first),
    }


def field(value: Column, name: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{name}", as_type)


def has_keys(value: Column, keys) -> Column:
    present = kind(value).startswith("OBJECT")
    for key in keys:
        present = present & field(value, key).isNotNull()
    return F.coalesce(present, F.lit(False))


def validate_segmentation(replies: DataFrame) -> DataFrame:
    """Adds `branch`, `cases` (array of variants, null if rejected) and `reason` (null if accepted)."""
    read = replies.withColumns(extract_json(F.col("content")))
    body = F.try_parse_json("json")
    listed = F.try_variant_get(body, "$.complete_cases", "array<variant>")
    is_list = F.coalesce(kind(field(body, "complete_cases")).startswith("ARRAY"), F.lit(False))
    reason = (
        F.when(F.col("json").isNull(), "no_json")
        .when(~is_list, "no_case_list")
        .when(~F.forall(listed, lambda c: has_keys(c, CASE_KEYS)), "missing_key")
    )
    checked = read.withColumn("reason", reason)
    return checked.withColumn("cases", F.when(F.col("reason").isNull(), listed)).drop("json")


def validate_review(replies: DataFrame) -> DataFrame:
    """Adds `needs_split`, `review_confidence`, `reasoning`, `points` and `reason` (null if accepted)."""
    read = replies.withColumns(extract_json(F.col("content")))
    body = F.try_parse_json("json")
    number = kind(field(body, "confidence")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    points = field(body, "suggested_split_points")
    reason = (
        F.when(F.col("json").isNull(), "no_json")
        .when(~has_keys(body, REVIEW_KEYS), "missing_key")
        .when(kind(field(body, "needs_split")) != "BOOLEAN", "bad_needs_split")
        .when(~number, "bad_confidence")
        .when(kind(field(body, "reasoning")) != "STRING", "bad_reasoning")
        .when(points.isNotNull() & ~kind(points).startswith("ARRAY"), "bad_points")
    )
    whole = F.transform(
        F.try_variant_get(body, "$.suggested_split_points", "array<variant>"),
        lambda p: F.when(kind(p) == "BIGINT", F.try_variant_get(p, "$", "bigint")),
    )
    none = F.array().cast("array<bigint>")
    return read.withColumns({
        "reason": reason,
        "needs_split": field(body, "needs_split", "boolean"),
        "review_confidence": field(body, "confidence", "double"),
        "reasoning": field(body, "reasoning", "string"),
        "points": F.coalesce(F.filter(whole, lambda p: p.isNotNull()), none),
    }).drop("json")


def first_good_reply(replies: DataFrame) -> DataFrame:
    """One reply per request: one without an error if there is any; of several, the one with the lowest content hash.

    Reply tables carry no order of arrival, so the pick has to come from the content to be the same on every run.
    Copies of a reply, as from a call made twice, collapse before the exchange.
    """
    columns = [c for c in replies.columns if c != "request_id"]
    best = F.min_by(F.struct(*columns), F.struct(F.col("error").isNotNull(), F.xxhash64("content")))
    return replies.groupBy("request_id").agg(best.alias("_r")).select("request_id", "_r.*")


def proposals(before: Column) -> Column:
    """Accepted `cases` as boundary structs, numbered from `before` on; a position or confidence of the wrong type becomes null."""
    def whole(case, name):
        return F.when(kind(field(case, name)) == "BIGINT", field(case, name, "bigint"))

    def boundary(case, at):
        number = kind(field(case, "confidence")).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        return F.struct(
            (before + at).cast("long").alias("case_index"),
            whole(case, "start_message").alias("start_pos"), whole(case, "end_message").alias("end_pos"),
            field(case, "summary", "string").alias("summary"),
            F.when(number, field(case, "confidence", "double")).alias("confidence"),
        )
    return F.transform("cases", boundary)


def explode_cases(checked: DataFrame) -> DataFrame:
    """Accepted replies to boundary rows."""
    before = F.col("cases_before") if "cases_before" in checked.columns else F.lit(0)
    kept = [c for c in checked.columns if c not in ("cases", "content", "branch", "reason")]
    return checked.where(F.col("cases").isNotNull()).select(*kept, F.inline(proposals(before)))


def reject_reason(start: Column, end: Column, confidence: Column) -> Column:
    """What is wrong with a range; null where `1 <= start <= end <= channel_messages`."""
    typed = start.isNotNull() & end.isNotNull() & confidence.isNotNull()
    inside = (start >= 1) & (start <= end) & (end <= F.col("channel_messages"))
    return F.when(~typed, "bad_type").when(~inside, "out_of_range")


def mark_ranges(boundaries: DataFrame) -> DataFrame:
    """`reject_reason` of each boundary row."""
    return boundaries.withColumn("reject_reason", reject_reason(*(F.col(c) for c in ("start_pos", "end_pos", "confidence"))))


def valid_ranges(boundaries: DataFrame) -> DataFrame:
    return mark_ranges(boundaries).where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_ranges(boundaries: DataFrame) -> DataFrame:
    return mark_ranges(boundaries).where(F.col("reject_reason").isNotNull())


def join_replies(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Requests (without their prompts) with their reply checked; `status` is ok, invalid, error or missing."""
    wanted = ["request_id", "channel_url", "part", "first_pos", "last_pos", "channel_messages", "channel_seq", "case_truncated"]
    asked = requests.select(*(c for c in wanted if c in requests.columns))
    answers = validate_segmentation(first_good_reply(replies.select("request_id", "content", "error")))
    status = (
        F.when(F.col("_answered").isNull(), "missing")
        .when(F.col("error").isNotNull(), "error")
        .when(F.col("reason").isNotNull(), "invalid")
        .otherwise("ok")
    )
    joined = asked.join(answers.withColumn("_answered", F.lit(True)).hint("merge"), ["request_id"], "left")
    several = not asked.where(F.col("part") > 0).isEmpty()
    cuts = blocks.find_cuts(asked, ["channel_url"], PART_ORDER) if several else None  # of the same rows, without their replies
    return beside_parts(joined.withColumn("status", status).drop("_answered"), several, cuts)


def beside_parts(joined: DataFrame, several: bool, cuts: Cuts | None = None) -> DataFrame:
    """What the other parts of the channel say: `cases_before` this part, `answered` (parts with a usable reply),
    `unasked` (parts without any reply is all there are), and `asked_from`, `asked_to`, the messages of all parts.

    Where no channel has `several` parts there is nothing beside a request. Else a scan counts, which cuts a channel of
    very many parts into blocks. The rows themselves go by channel, once: a join with counts would read the replies twice.
    """
    ok = F.col("status") == "ok"
    if not several:
        return joined.withColumns({
            "cases_before": F.lit(0).cast("long"), "answered": ok.cast("long"), "unasked": F.col("status") == "missing",
            "asked_from": F.col("first_pos"), "asked_to": F.col("last_pos"),
        })
    n = F.coalesce(F.size("cases"), F.lit(1))
    o = blocks.in_blocks(joined, ["channel_url"], PART_ORDER, cuts)
    rows = blocks.finish(blocks.scan(
        o, _upto=Step("sum", n), answered=Step("total", ok.cast("long")), _replies=Step("total", (F.col("status") != "missing").cast("long")),
        asked_from=Step("least", F.col("first_pos")), _to=Step("least", -F.col("last_pos")),
    ))
    return rows.select(
        *joined.columns, (F.col("_upto") - n).alias("cases_before"), "answered", (F.col("_replies") == 0).alias("unasked"),
        "asked_from", (-F.col("_to")).alias("asked_to"),
    )


def fallback() -> Column:
    """Boundary structs of a request without usable reply.

    Where no part of the channel has one, a single case takes the place of all parts; else one over the request.
    """
    alone = F.col("answered") == 0
    missing = F.when(alone, F.col("unasked")).otherwise(F.col("status") == "missing")
    case = F.struct(
        F.when(alone, 0).otherwise(F.col("cases_before")).cast("long").alias("case_index"),
        F.when(alone, F.col("asked_from")).otherwise(F.col("first_pos")).alias("start_pos"),
        F.when(alone, F.col("asked_to")).otherwise(F.col("last_pos")).alias("end_pos"),
        F.when(missing, NO_REPLY_SUMMARY).otherwise(FAILED_SUMMARY).alias("summary"),
        F.when(missing, NO_REPLY_CONFIDENCE).otherwise(FAILED_CONFIDENCE).alias("confidence"),
    )
    return F.when(alone & (F.col("first_pos") > F.col("asked_from")), F.slice(F.array(case), 1, 0)).otherwise(F.array(case))


def fallback_of_part() -> Column:
    """Boundary structs of a request without usable reply, as a case of its own part."""
    missing = F.col("status") == "missing"
    return F.array(F.struct(
        F.lit(0).cast("long").alias("case_index"), F.col("first_pos").alias("start_pos"), F.col("last_pos").alias("end_pos"),
        F.when(missing, NO_REPLY_SUMMARY).otherwise(FAILED_SUMMARY).alias("summary"),
        F.when(missing, NO_REPLY_CONFIDENCE).otherwise(FAILED_CONFIDENCE).alias("confidence"),
    ))


def _channel(joined: DataFrame) -> list[str]:
    return [c for c in ("channel_url", "channel_messages", "channel_seq", "case_truncated") if c in joined.columns]


def fallback_cases(joined: DataFrame) -> DataFrame:
    """The cases of requests without usable reply."""
    return joined.where(F.col("status") != "ok").select(*_channel(joined), F.inline(fallback()))


def boundaries_of_replies(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """All proposed boundaries of all requests, fallbacks included; not yet checked for their range.

    Case numbers are dense in a channel over all its parts. `case_truncated` comes along if the requests have it.
    """
    joined = join_replies(requests, replies)
    listed = F.when(F.col("status") == "ok", proposals(F.col("cases_before"))).otherwise(fallback())
    return joined.select(*_channel(joined), F.inline(listed))
