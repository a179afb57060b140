"""Channel sizes, size bands and channel selection."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from convocases.operators.blocks import ROWS_PER_BLOCK, join_spread

# Limits of the size bands and the number of candidates for the largest one.
MANY_ABOVE, MEDIUM_FROM, TOP_CHANNELS = 50, 10, 5
BROADCAST_CHANNELS = 100_000


def channel_counts(messages: DataFrame) -> DataFrame:
    """Messages per channel; rows with a blank channel are left out."""
    named = messages.where(F.coalesce(F.col("channel_url"), F.lit("")) != "")
    return named.groupBy("channel_url").agg(F.count(F.lit(1)).alias("n_messages"))


def size_band(n: Column) -> Column:
    return F.when(n > MANY_ABOVE, "many").when(n >= MEDIUM_FROM, "medium").otherwise("few")


def channel_size_bands(counts: DataFrame) -> DataFrame:
    """Channels per size band with the largest and mean size in the band and overall."""
    bands = counts.rollup(size_band(F.col("n_messages")).alias("size_band")).agg(
        F.count(F.lit(1)).alias("channels"), F.max("n_messages").alias("largest"), F.avg("n_messages").alias("mean")
    )
    return bands.withColumn("size_band", F.coalesce("size_band", F.lit("all")))


def channel_size_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count(F.lit(1)).alias("channels"),
        F.min("n_messages").alias("min_messages"),
        F.max("n_messages").alias("max_messages"),
        F.avg("n_messages").alias("avg_messages"),
    )


def largest_channels(counts: DataFrame, n: int = TOP_CHANNELS) -> DataFrame:
    return counts.orderBy(F.desc("n_messages"), "channel_url").limit(n)


def representative_channels(counts: DataFrame, seed: int = 0, by_rank: bool = False) -> DataFrame:
    """One channel per size band: of the top five for `many`, any for the others.

    The pick follows a seeded hash; with `by_rank` it is the largest of the band. Ranks are computed as
    top-k limits before the exchange, so no band is gathered whole.
    """
    banded = counts.withColumn("size_band", size_band(F.col("n_messages")))
    by_size = [F.desc("n_messages"), F.asc("channel_url")]
    top = banded.where(F.col("size_band") == "many").orderBy(*by_size).limit(TOP_CHANNELS)
    pool = top.unionByName(banded.where(F.col("size_band") != "many"))
    pick = by_size if by_rank else [F.xxhash64("channel_url", F.lit(seed)), F.asc("channel_url")]
    rank = F.row_number().over(Window.partitionBy("size_band").orderBy(*pick))
    return pool.withColumn("_rank", rank).where(F.col("_rank") <= 1).drop("_rank")


def filter_channels(
    messages: DataFrame, channels: DataFrame | Sequence[str], empty_selection: str = "all",
    broadcast_channels: int = BROADCAST_CHANNELS, hot_rows: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Keep the rows of the listed channels (a list, or a table with `channel_url`).

    An empty selection keeps every row, or none with `empty_selection='none'`. A table of up to
    `broadcast_channels` channels is broadcast, so the messages do not move; a longer one is joined with channels of
    `hot_rows` rows or more dealt out.
    """
    if not isinstance(channels, DataFrame):
        wanted = list(channels)
        if not wanted and empty_selection == "all":
            return messages
        return messages.where(F.col("channel_url").isin(*wanted)) if wanted else messages.where(F.lit(False))
    if empty_selection == "all" and channels.isEmpty():
        return messages
    wanted = channels.select("channel_url").distinct()
    if wanted.limit(broadcast_channels + 1).count() <= broadcast_channels:
        return messages.join(F.broadcast(wanted), ["channel_url"], "left_semi")
    return join_spread(messages, wanted, ["channel_url"], "left_semi", hot_rows=hot_rows)


def missing_channels(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Listed channels that have no message."""
    present = messages.select("channel_url").distinct()
    return channels.select("channel_url").distinct().join(present, ["channel_url"], "left_anti")
