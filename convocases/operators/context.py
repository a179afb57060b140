"""Context control: token budgets, sink-and-recent selection, overlapping chunks, pair coherence."""

from pyspark.sql import Column, DataFrame, functions as F

from convocases.functions import text
from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Step
from convocases.operators.messages import drop_untimed, in_channel_order

# Default limits.
MAX_CONTEXT_TOKENS, RESERVE_TOKENS = 128_000, 2_000
SINK_SIZE, MAX_QUEUE_SIZE = 4, 50
CHUNK_SIZE, COHERENCE_THRESHOLD = 32, 0.3


def with_running_tokens(messages: DataFrame, tokens: Column | None = None, cuts: Cuts | None = None) -> DataFrame:
    """Position, tokens of the message, of the channel up to and with it, and of the whole channel."""
    tokens = text.approx_tokens(F.col("message")) if tokens is None else tokens
    rows = drop_untimed(messages).withColumn("tokens", tokens)
    o = in_channel_order(rows, cuts)
    o = blocks.scan(
        o, pos=Step("row_number"), running_tokens=Step("sum", F.col("tokens")),
        channel_tokens=Step("total", F.col("tokens")), channel_messages=Step("count"),
        channel_seq=Step("least", F.col("ingest_seq")),
    )
    return blocks.finish(o)


def fit_token_budget(
    messages: DataFrame, max_context: int = MAX_CONTEXT_TOKENS, reserve: int = RESERVE_TOKENS,
    tokens: Column | None = None, cuts: Cuts | None = None,
) -> DataFrame:
    """Longest prefix of each channel within `max_context - reserve` tokens.

    `case_truncated` says that messages of the channel were left out.
    """
    budget = max_context - reserve
    rows = with_running_tokens(messages, tokens, cuts)
    kept = rows.where(F.col("running_tokens") <= budget)
    return kept.withColumn("case_truncated", F.col("channel_tokens") > budget)


def sink_and_recent(
    messages: DataFrame, sink: int = SINK_SIZE, max_queue_size: int = MAX_QUEUE_SIZE, cuts: Cuts | None = None
) -> DataFrame:
    """First `sink` messages of each channel and the most recent ones, `max_queue_size` in all."""
    o = in_channel_order(drop_untimed(messages), cuts)
    rows = blocks.finish(blocks.scan(o, pos=Step("row_number"), channel_messages=Step("count")))
    recent = F.col("pos") > F.col("channel_messages") - (max_queue_size - sink)
    part = F.when(F.col("pos") <= sink, "sink").when(recent, "recent")
    return rows.withColumn("context_part", part).where(F.col("context_part").isNotNull())


def overlap_windows(
    messages: DataFrame, batch_size: int = CHUNK_SIZE, overlap: int = 0, cuts: Cuts | None = None
) -> DataFrame:
    """Chunks of `batch_size` positions, each sharing `overlap` with the one before.

    A message appears once per chunk it lies in; no chunk starts beyond the one that reaches the end.
    """
    if not 0 <= overlap < batch_size:
        raise ValueError("overlap must be at least 0 and below batch_size")
    stride = batch_size - overlap
    o = in_channel_order(drop_untimed(messages), cuts)
    rows = blocks.finish(blocks.scan(o, pos=Step("row_number"), channel_messages=Step("count")))
    chunk = lambda value: F.floor(value / stride).cast("long")
    zero = F.lit(0).cast("long")
    first = F.greatest(zero, chunk(F.col("pos") - 1 - batch_size) + 1)
    final = F.greatest(zero, F.ceil((F.col("channel_messages") - batch_size) / stride).cast("long"))
    last = F.least(chunk(F.col("pos") - 1), final)
    return rows.withColumn("chunk", F.explode(F.sequence(first, last)))


def pair_coherence(
    rows: DataFrame, keys: list[str], order: list[str], vector: str = "embedding",
    threshold: float = COHERENCE_THRESHOLD, rows_per_block: int = blocks.ROWS_PER_BLOCK,
) -> DataFrame:
    """Cosine of each row's vector with the one before it; a low value marks a candidate boundary."""
    o = blocks.in_blocks(rows, keys, order, rows_per_block=rows_per_block)
    o = blocks.scan(o, _previous=Step("lag", F.col(vector)))
    value = text.cosine(F.col(vector), F.col("_previous"))
    out = blocks.finish(o).withColumn("coherence", value)
    candidate = F.coalesce(F.col("coherence") < threshold, F.lit(False))
    return out.withColumn("candidate_boundary", candidate).drop("_previous")


def coherence_depth(
    rows: DataFrame, keys: list[str], order: list[str], vector: str = "embedding", rows_per_block: int = blocks.ROWS_PER_BLOCK,
) -> DataFrame:
    """`coherence` with the row before, and `depth`: how far it falls below the peaks on both sides.

    A peak is where the coherence stops to rise when one goes away from a row, so a single low value in a coherent
    stretch is deep, and one in a stretch of low values is not. Coherence counts to six places. The first row of a group,
    and a row without a vector or after one, has neither; others climb past it. One scan goes forward and one back.
    """
    cuts = blocks.find_cuts(rows, keys, order, rows_per_block)
    o = blocks.in_blocks(rows, keys, order, cuts)
    o = blocks.scan(o, _previous=Step("lag", F.col(vector)), _place=Step("row_number"), _length=Step("count"))
    o = o._replace(rows=o.rows.withColumn("coherence", F.round(text.cosine(F.col(vector), F.col("_previous")), 6)).drop("_previous"))

    def peak(o: blocks.Ordered, name: str) -> blocks.Ordered:
        """The value at which a climb against the order ends."""
        o = blocks.scan(o, _near=Step("last", F.col("coherence")))
        foot = F.when(F.col("_near").isNull() | (F.col("_near") < F.col("coherence")), F.col("coherence"))
        o = o._replace(rows=o.rows.withColumn("_foot", foot))
        o = blocks.scan(o, _climbed=Step("last", F.col("_foot")))
        return o._replace(rows=o.rows.withColumn(name, F.coalesce("_foot", "_climbed")).drop("_near", "_foot", "_climbed"))

    forward = blocks.finish(peak(o, "_left")).withColumn("_back", F.col("_length") - F.col("_place") + 1)
    back = blocks.by_place(forward, keys, "_back", F.col("_back"), F.col("_length"), bool(cuts.rows))
    back = back._replace(null_keys=o.null_keys)
    out = blocks.finish(peak(back, "_right"))
    depth = F.round(F.col("_left") + F.col("_right") - 2 * F.col("coherence"), 6)
    return out.withColumn("depth", F.when(F.col("coherence").isNotNull(), depth)).drop("_left", "_right", "_place", "_length", "_back")
