"""Request tables for a model, the seam that calls it, and retries.

Request texts are bounded: a channel or case beyond the token budget is asked in several parts, each with
its own messages and the numbering of the whole.
"""

import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from convocases.functions import text
from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Ordered, Step
from convocases.operators.cases import CASE, cases_to_messages_range
from convocases.operators.classify import candidate_leaves, format_case_excerpt
from convocases.operators.cases import assigned_only
from convocases.operators.context import MAX_CONTEXT_TOKENS, RESERVE_TOKENS
from convocases.operators.messages import drop_untimed, in_channel_order
from convocases.operators.taxonomy import MAX_TAXONOMY_ROWS, format_leaves, format_taxonomy
from convocases.sources.scratch import checkpointed

REPLY_SCHEMA = (
    "request_id string, content string, input_tokens long, output_tokens long, "
    "model string, provider string, seconds double, error string"
)

SEGMENT_TASK = """Below is a support chat, one numbered message after the other. Divide it into cases: runs of
messages about one matter. A new order, product or problem starts a new case; thanks, follow-ups and delayed
answers belong to the case they refer to. Every message belongs to one case.
Answer with JSON only: {"complete_cases": [{"start_message": first number, "end_message": last number,
"summary": short text, "confidence": 0 to 1}]}.

"""
REVIEW_TASK = """Below are the numbered messages of one support case. Say whether it holds more than one matter
and where it should be cut.
Answer with JSON only: {"needs_split": true or false, "confidence": 0 to 1, "reasoning": short text,
"suggested_split_points": [message numbers]}.

"""
CLASSIFY_TASK = """Choose the one primary and one secondary category that fit this support case best.
Answer with JSON inside <output> tags: {"primary_category": ..., "secondary_category": ...,
"confidence": 0 to 1, "reasoning": short text}.

"""


def message_line(number: Column) -> Column:
    """One message as tagged text."""
    time = F.date_format("created_time", "yyyy-MM-dd HH:mm:ss")
    fields = (F.coalesce(F.col(c), F.lit("")) for c in ("sender_id", "sender_type"))
    return F.format_string(
        '<message id="%d">\n<sender>%s</sender>\n<sender_type>%s</sender_type>\n<time>%s</time>\n'
        "<content>%s</content>\n</message>\n\n", number, *fields, time, F.col("message"),
    )


def transcript_parts(
    o: Ordered, number: str = "pos", budget: int = MAX_CONTEXT_TOKENS - RESERVE_TOKENS,
    carry: Sequence[str] = (), token_expr: Callable[[Column], Column] = text.approx_tokens, overlap: int = 0,
) -> DataFrame:
    """Tagged text of each group in order, cut into parts of `budget` tokens.

    Part 0 is the longest prefix within the budget; a later part exceeds it by one message at most. With `overlap`, in
    tokens, a part begins so much before the end of the one before it; messages longer than that are not shared.
    """
    if not 0 <= overlap <= budget // 2:
        raise ValueError("overlap must be at least 0 and at most half of the budget")
    o = o._replace(rows=o.rows.withColumn("_line", message_line(F.col(number))))
    o = o._replace(rows=o.rows.withColumn("_tokens", token_expr(F.col("_line"))))
    running = Step("sum", F.col("_tokens"))
    if overlap:
        rows = blocks.finish(blocks.scan(o, _running=running, _whole=Step("total", F.col("_tokens"))))
        own, zero = budget - overlap, F.lit(0).cast("long")
        final = F.greatest(zero, F.ceil((F.col("_whole") - budget) / own))  # the part that reaches the end
        first = F.greatest(zero, F.ceil((F.col("_running") - budget) / own))
        last = F.least(F.floor(F.greatest(F.col("_running") - 1, zero) / own), final)
        rows = rows.withColumn("_part", F.explode(F.sequence(F.least(first, last), last)))
        part = F.col("_part").cast("int").alias("part")
    else:
        rows = blocks.finish(blocks.scan(o, _running=running))
        part = F.floor(F.greatest(F.col("_running") - 1, F.lit(0)) / budget).cast("int").alias("part")
    lines = F.sort_array(F.collect_list(F.struct(F.col(number).alias("n"), "_line")))
    return rows.groupBy(*o.keys, part).agg(
        *(F.min(c).alias(c) for c in carry),
        F.min(number).alias("first_pos"), F.max(number).alias("last_pos"),
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("_tokens").alias("transcript_tokens"),
        F.array_join(F.transform(lines, lambda x: x["_line"]), "").alias("transcript"),
    )


def format_transcript(messages: DataFrame, cuts: Cuts | None = None, **options) -> DataFrame:
    """Transcript of each channel (in parts where it is over the budget)."""
    o = in_channel_order(drop_untimed(messages), cuts)
    o = blocks.scan(
        o, pos=Step("row_number"), channel_messages=Step("count"), channel_seq=Step("least", F.col("ingest_seq"))
    )
    return transcript_parts(o, carry=("channel_messages", "channel_seq"), **options)


def as_requests(parts: DataFrame, call_type: str, id_columns: Sequence[Column], prompt: Column) -> DataFrame:
    request_id = F.concat_ws(":", F.lit(call_type), *(c.cast("string") for c in id_columns))
    out = parts.withColumns({"request_id": request_id, "call_type": F.lit(call_type), "prompt": prompt})
    return out.withColumn("prompt_tokens", text.approx_tokens(F.col("prompt"))).drop("transcript", "transcript_tokens")


def segmentation_requests(
    messages: DataFrame, cuts: Cuts | None = None, overflow: str = "parts", task: str = SEGMENT_TASK, **options
) -> DataFrame:
    """One request per channel and part; `overflow='truncate'` keeps only what fits the first part.

    With `overlap`, in tokens, neighbouring parts share messages, and the replies are stitched so that cases cross them.
    """
    parts = format_transcript(messages, cuts, **options)
    if options.get("overlap"):
        parts = parts.withColumn("overlap", F.lit(options["overlap"]))
    if overflow == "truncate":
        parts = parts.where(F.col("part") == 0)
    elif overflow != "parts":
        raise ValueError("overflow must be 'parts' or 'truncate'")
    left_out = F.lit(overflow == "truncate") & (F.col("last_pos") < F.col("channel_messages"))
    ids = (F.col("channel_url"), F.col("part"))
    prompt = F.concat(F.lit(task), F.col("transcript"))
    return as_requests(parts.withColumn("case_truncated", left_out), "segment", ids, prompt)


def review_requests(
    boundaries: DataFrame, positioned: DataFrame, round_no: int = 0, task: str = REVIEW_TASK, **options
) -> DataFrame:
    """One request per valid case and part, with message numbers counted inside the case."""
    ranges = boundaries.select(*CASE, "start_pos", "end_pos")
    fields = ("channel_url", "pos", "created_time", "sender_id", "sender_type", "message")
    rows = cases_to_messages_range(ranges, positioned.select(*fields))
    rows = rows.withColumn("case_pos", F.col("pos") - F.col("start_pos") + 1)
    length = F.col("end_pos") - F.col("start_pos") + 1
    any_long = not ranges.where(length > blocks.ROWS_PER_BLOCK).isEmpty()
    o = blocks.by_place(rows, CASE, "pos", F.col("case_pos"), length, any_long)
    parts = transcript_parts(o, number="case_pos", carry=("start_pos",), **options)
    ids = (F.lit(round_no), F.col("channel_url"), F.col("case_index"), F.col("part"))
    return as_requests(parts, "review", ids, F.concat(F.lit(task), F.col("transcript")))


def classification_requests(
    labelled: DataFrame, taxonomy: DataFrame, task: str = CLASSIFY_TASK, leaves_per_case: int | None = None,
) -> DataFrame:
    """One request per case: id, summary, duration, number of messages, first messages, category list.

    The list is the whole taxonomy, which may then have `MAX_TAXONOMY_ROWS` leaves; with `leaves_per_case`, it names the
    leaves that fit the case best and the fallback, and the taxonomy may have any size.
    """
    if leaves_per_case is None and taxonomy.limit(MAX_TAXONOMY_ROWS + 1).count() > MAX_TAXONOMY_ROWS:
        raise ValueError(f"over {MAX_TAXONOMY_ROWS} leaves in every prompt: give leaves_per_case")
    first = F.struct("created_time", "ingest_seq", "message_id")
    facts = assigned_only(labelled).groupBy("case_number").agg(
        F.min_by("case_summary", first).alias("case_summary"),
        F.min_by("case_duration_minutes", first).alias("case_duration_minutes"),
        F.count(F.lit(1)).alias("n_messages"),
    )
    rows = facts.join(format_case_excerpt(labelled), ["case_number"])
    head = F.format_string(
        "Case: %s\nSummary: %s\nDuration: %.1f minutes\nMessages: %d\n\n",
        "case_number", "case_summary", F.bround("case_duration_minutes", 1), "n_messages",
    )
    if leaves_per_case is None:
        names = F.lit(format_taxonomy(taxonomy).first()["taxonomy_text"])
    else:
        leaf = F.struct("primary_no", "leaf_no", "primary", "secondary")
        offered = candidate_leaves(labelled, taxonomy, leaves_per_case).groupBy("case_number").agg(
            format_leaves(F.collect_list(leaf)).alias("_names"))
        rows, names = rows.join(offered, ["case_number"], "left"), F.coalesce("_names", F.lit(""))
    prompt = F.concat(F.lit(task), head, F.col("excerpt"), F.lit("\n\n"), names)
    rows = rows.withColumn("prompt", prompt).drop("_names")
    return as_requests(rows, "classify", (F.col("case_number"),), F.col("prompt"))


def nullable(column: pd.Series, kind: str) -> pd.Series:
    if kind == "long":
        return column.astype("Int64")
    if kind == "double":
        return column.astype("float64")
    return pd.Series([None if pd.isna(v) else str(v) for v in column], index=column.index, dtype=object)


def map_requests(
    requests: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], concurrency: int | None = None, slice_rows: int = 100,
) -> DataFrame:
    """Reply table from a batch callable, run by `concurrency` tasks (default: as the requests are partitioned).

    `fn` takes up to `slice_rows` requests and returns rows with `request_id, content` and, as it likes, the other
    reply columns. If it raises, its requests are asked again one at a time, so an error stays with the request that
    causes it and what other slices returned is kept. A request that fails alone, or that `fn` leaves out, gets an
    error row. Write or checkpoint the result before reading it twice: each evaluation calls `fn` again.
    """
    kinds = dict(part.split() for part in REPLY_SCHEMA.split(", "))
    names = list(kinds)

    def ask(batch: pd.DataFrame) -> pd.DataFrame:
        try:
            answer = fn(batch).reindex(columns=names).drop_duplicates("request_id")
        except Exception as problem:  # a failed call is a row, not a failed job
            if len(batch) > 1:
                return pd.concat([ask(batch.iloc[i:i + 1]) for i in range(len(batch))], ignore_index=True)
            return batch[["request_id"]].reindex(columns=names).assign(error=f"{type(problem).__name__}: {problem}")
        joined = batch[["request_id"]].merge(answer, on="request_id", how="left").astype({"error": object})
        joined.loc[joined["content"].isna() & joined["error"].isna(), "error"] = "no reply"
        return joined

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), slice_rows):
                joined = ask(batch.iloc[at:at + slice_rows])
                yield pd.DataFrame({n: nullable(joined[n], kind) for n, kind in kinds.items()})

    dealt = requests.repartition(concurrency, "request_id") if concurrency else requests
    return dealt.mapInPandas(call, REPLY_SCHEMA)


class Pace:
    """Starts of calls so far apart that `tokens_per_minute` are not exceeded on the long run; no limit without it."""

    def __init__(self, tokens_per_minute: float | None):
        self.seconds = 60 / tokens_per_minute if tokens_per_minute else 0.0
        self.free = time.monotonic()

    def wait(self, tokens: float) -> None:
        now = time.monotonic()
        start = max(now, self.free)
        self.free = start + tokens * self.seconds
        if start > now:
            time.sleep(start - now)


def call_requests(
    requests: DataFrame, fn: Callable[[dict], dict | str], tasks: int, in_flight: int = 16,
    tokens_per_minute: float | None = None, tokens: str = "prompt_tokens", slice_rows: int = 100,
) -> DataFrame:
    """Reply table from a callable that takes one request and waits for its answer, with many calls under way at once.

    `fn` gets a request as a dict of its columns and returns the content, or a dict with `content` and other reply
    columns. Each of `tasks` tasks keeps up to `in_flight` calls open on threads of its own, so a slow call holds up none
    of the others, and reads on only as calls end. `tokens_per_minute` is a budget for the whole job: each task starts
    its calls at its share of it, by the requests' column `tokens`, and the shares add up to the budget however many of
    the tasks run at once. Every request gets one row; if `fn` raises or returns no content, that row has the error.
    Write or checkpoint the result before reading it twice: each evaluation calls `fn` again.
    """
    kinds = dict(part.split() for part in REPLY_SCHEMA.split(", "))
    share = tokens_per_minute / tasks if tokens_per_minute else None

    def ask(request: dict) -> dict:
        begun = time.monotonic()
        try:
            answer = fn(request)
            row = dict(answer) if isinstance(answer, dict) else {"content": answer}
            if row.get("content") is None and row.get("error") is None:
                row["error"] = "no reply"
        except Exception as problem:  # a failed call is a row, not a failed job
            row = {"error": f"{type(problem).__name__}: {problem}"}
        return {"seconds": time.monotonic() - begun, **row, "request_id": request["request_id"]}

    def table(rows: list[dict]) -> pd.DataFrame:
        frame = pd.DataFrame(rows).reindex(columns=list(kinds))
        return pd.DataFrame({n: nullable(frame[n], kind) for n, kind in kinds.items()})

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace, under_way, done = Pace(share), set(), []
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                for request in batch.to_dict("records"):
                    if len(under_way) == in_flight:
                        ended, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                        done += [f.result() for f in ended]
                    if share:
                        pace.wait(float(request[tokens]))
                    under_way.add(pool.submit(ask, request))
                    if len(done) >= slice_rows:
                        yield table(done)
                        done = []
            done += [f.result() for f in under_way]
        if done:
            yield table(done)

    return requests.repartition(tasks, "request_id").mapInPandas(call, REPLY_SCHEMA)


def retry_failed_requests(
    requests: DataFrame, replies: DataFrame, fns: Sequence[Callable], concurrency: int | None = None
) -> DataFrame:
    """Requests without a good reply go to the next callable; the first good reply wins.

    Every round of replies is checkpointed, so no call is repeated. The last error is kept where all fail.
    """
    def good(rows):
        return rows.where(F.col("error").isNull())

    all_replies = replies
    for fn in fns:
        pending = requests.join(good(all_replies).select("request_id"), ["request_id"], "left_anti")
        again = checkpointed(map_requests(pending, fn, concurrency))
        failed_before = all_replies.where(F.col("error").isNotNull())
        superseded = failed_before.join(again.select("request_id"), ["request_id"], "left_anti")
        all_replies = good(all_replies).unionByName(superseded).unionByName(again)
    return all_replies
