"""Message table: typing, cleaning, filters, order inside a channel."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from convocases.functions import text
from convocases.operators import blocks
from convocases.operators.blocks import Cuts, Ordered, Step

# Source column names in output order, and their names here.
REQUIRED = {
    "Created Time": "created_time",
    "Sender ID": "sender_id",
    "Real Sender ID": "real_sender_id",
    "Message": "message",
    "Message ID": "message_id",
    "Type": "type",
    "Channel URL": "channel_url",
    "File URL": "file_url",
    "Sender Type": "sender_type",
}
#: Column in which a reader puts the line of a row that doesn't fit the header.
MALFORMED = "_malformed"
CHANNEL = ["channel_url"]
TIME_ORDER = ["created_time", "ingest_seq", "message_id"]


def rename_source_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in REQUIRED.items() if old in df.columns})


def project_required(df: DataFrame) -> DataFrame:
    """Required columns first, in their fixed order ('' where absent), then all other columns."""
    required = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in REQUIRED.values()]
    return df.select(*required, *(c for c in df.columns if c not in REQUIRED.values()))


def collect_round_columns(df: DataFrame) -> Column:
    """All columns whose name starts with `round`, as one map."""
    names = [c for c in df.columns if c.startswith("round") and c != "round_columns"]
    if not names:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*(part for c in names for part in (F.lit(c), F.col(f"`{c}`").cast("string"))))


def has_ids() -> Column:
    return (F.coalesce(F.col("message_id"), F.lit("")) != "") & (F.coalesce(F.col("channel_url"), F.lit("")) != "")


def require_ids(df: DataFrame) -> DataFrame:
    """Rows without a message id or channel are dropped."""
    return df.where(has_ids())


def drop_untimed(df: DataFrame) -> DataFrame:
    """Rows without a usable time take no part in segmentation."""
    return df.where(F.col("created_time").isNotNull())


def drop_types(df: DataFrame, types: Sequence[str] = ("FILE",)) -> DataFrame:
    return df.where(~F.coalesce(F.col("type"), F.lit("")).isin(*types))


def clean_messages(df: DataFrame, straighten: bool = False, drop: Sequence[str] = ()) -> DataFrame:
    """Raw text rows to cleaned ones: ids required, text cleaned, time parsed, sender type filled.

    Required columns come first, empty where the source has none. Malformed rows are dropped, as `preprocess_stats`
    counts them. `created_time_raw` keeps the original text. A row with a bad time stays, with a null time.
    """
    if MALFORMED in df.columns:
        df = df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    df = require_ids(project_required(rename_source_columns(df)))
    if drop:
        df = drop_types(df, drop)
    return df.withColumns({
        "message": text.clean_message(F.col("message"), straighten),
        "created_time_raw": F.col("created_time"),
        "created_time": text.parse_created_time(F.col("created_time")),
        "sender_type": text.derive_sender_type(F.col("sender_type"), F.col("sender_id")),
    })


def load_messages(df: DataFrame) -> DataFrame:
    """Cleaned table to typed messages: untimed rows dropped, `round*` columns gathered into one map."""
    rounds = [c for c in df.columns if c.startswith("round")]
    typed = df.withColumn("round_columns", collect_round_columns(df)).drop(*rounds)
    if dict(df.dtypes)["created_time"] == "string":
        typed = typed.withColumn("created_time", text.parse_created_time(F.col("created_time")))
    if "review" not in df.columns:
        typed = typed.withColumn("review", F.lit(""))
    return drop_untimed(typed)


def message_cuts(messages: DataFrame, rows_per_block: int = blocks.ROWS_PER_BLOCK) -> Cuts:
    """Cuts of over-large channels; compute once and hand to every operator on the same messages."""
    return blocks.find_cuts(messages, CHANNEL, TIME_ORDER, rows_per_block)


def in_channel_order(messages: DataFrame, cuts: Cuts | None = None) -> Ordered:
    return blocks.in_blocks(messages, CHANNEL, TIME_ORDER, cuts)


def message_positions(messages: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """1-based `pos` in the channel by time, then ingest order, then id."""
    ordered = in_channel_order(drop_untimed(messages), cuts)
    return blocks.finish(blocks.scan(ordered, pos=Step("row_number")))


def sort_messages(messages: DataFrame) -> DataFrame:
    """Channels contiguous, time order inside, untimed rows first.

    The range exchange is on the whole sort key, so one giant channel spreads over many partitions.
    """
    return messages.orderBy("channel_url", *TIME_ORDER)


def sample_rows(messages: DataFrame, n: int) -> DataFrame:
    """The first `n` rows in channel and time order."""
    return sort_messages(messages).limit(n)
