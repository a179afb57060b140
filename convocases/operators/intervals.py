"""Overlapping ranges of positions as disjoint intervals, each with the last of the ranges that cover it."""

from pyspark.sql import Column, DataFrame, functions as F

from convocases.operators import blocks
from convocases.operators.blocks import Step
from convocases.sources.scratch import checkpointed

#: Levels of dyadic blocks that intervals look up themselves; wider blocks are looked up once for 2^LOW intervals.
LOW = 10


def _nodes(low: str, high: str) -> Column:
    """The dyadic blocks (level h, number node) that make up the elementary intervals from `low` to before `high`: at most two a level."""
    left, right = f"shiftright({low} + shiftleft(1L, h) - 1, h)", f"shiftright({high}, h)"  # rounded inwards
    return F.expr(
        f"filter(flatten(transform(sequence(0, cast(floor(log2({high} - {low})) as int)), h -> array("
        f"if({left} < {right} and {left} % 2 = 1, named_struct('h', h, 'node', {left}), null),"
        f"if({left} < {right} and {right} % 2 = 1, named_struct('h', h, 'node', {right} - 1), null)))), x -> x is not null)")


def reached_over(ranges: DataFrame, *ties: str) -> DataFrame:
    """The ranges that an earlier one of their channel, by start, end and `ties`, reaches into."""
    rows = ranges.where("start_pos <= end_pos")
    o = blocks.in_blocks(rows, ["channel_url"], ["start_pos", "end_pos", *ties])
    o = blocks.scan(o, _reach=Step("max", F.col("end_pos")))
    o = blocks.scan(o, _before=Step("lag", F.col("_reach")))
    return blocks.finish(o).where(F.col("_before") >= F.col("start_pos")).select(*ranges.columns)


def disjoint(ranges: DataFrame, value: str) -> DataFrame:
    """`channel_url, start_pos, end_pos, <value>`: disjoint intervals with the largest `value` of the ranges over them.

    Channels whose ranges don't overlap keep them as they are. In the others the starts and ends cut the positions into
    elementary intervals. A range is handed to the few dyadic blocks of these that make it up, each block keeps its
    largest value, and an interval takes the largest of the blocks it lies in. So k nested ranges cost k log k rows, and
    none meets another. Blocks of many intervals are looked up once for each 2^LOW of them, so no key gets hot.
    Both sides of each join grow with the ranges and compressed files look small, so none is broadcast.
    """
    rows = ranges.select("channel_url", "start_pos", "end_pos", value).where("start_pos <= end_pos")
    tangled = checkpointed(reached_over(rows, value).select("channel_url").distinct())
    if tangled.isEmpty():
        return rows
    tangled = tangled.hint("merge")
    plain = rows.join(tangled, rows.channel_url.eqNullSafe(tangled.channel_url), "left_anti")
    rows = rows.join(tangled, rows.channel_url.eqNullSafe(tangled.channel_url), "left_semi")
    return plain.unionByName(_largest(rows, value).select(*plain.columns))


def _largest(rows: DataFrame, value: str) -> DataFrame:
    rows = rows.withColumn("channel_url", F.struct("channel_url"))  # null channels meet in joins
    borders = rows.select("channel_url", F.explode(F.array("start_pos", F.col("end_pos") + 1)).alias("_border")).distinct()
    o = blocks.in_blocks(borders, ["channel_url"], ["_border"])
    placed = checkpointed(blocks.finish(blocks.scan(o, _n=Step("row_number"))).withColumn("_i", F.col("_n") - 1).drop("_n"))
    ends = placed.select("channel_url", (F.col("_i") - 1).alias("_i"), (F.col("_border") - 1).alias("end_pos"))
    elementary = placed.withColumnRenamed("_border", "start_pos").join(ends.hint("merge"), ["channel_url", "_i"])

    at = lambda name, to: placed.select("channel_url", F.col("_border").alias(name), F.col("_i").alias(to))
    held = rows.withColumn("_after", F.col("end_pos") + 1).join(at("start_pos", "_low").hint("merge"), ["channel_url", "start_pos"])
    held = held.join(at("_after", "_high").hint("merge"), ["channel_url", "_after"])
    nodes = held.select("channel_url", value, F.inline(_nodes("_low", "_high"))).groupBy("channel_url", "h", "node").agg(F.max(value).alias(value))
    nodes = checkpointed(nodes)

    def over(things: DataFrame, i: str, first: int, last: int, shift: int) -> DataFrame:
        """The largest value of the levels from `first` to `last` over each thing, a block of 2^shift intervals."""
        asked = things.withColumn("h", F.explode(F.sequence(F.lit(first), F.lit(last))))
        asked = asked.withColumn("node", F.expr(f"shiftright({i}, h - {shift})"))
        some = nodes.where(F.col("h").between(first, last))
        return asked.join(some.hint("merge"), ["channel_url", "h", "node"]).groupBy("channel_url", i).agg(F.max(value).alias(f"_{value}_{shift}"))

    elementary = elementary.withColumn("_b", F.shiftright("_i", LOW))
    levels = nodes.agg(F.max("h")).first()[0]
    low = over(elementary.select("channel_url", "_i"), "_i", 0, min(levels, LOW - 1), 0)
    found = elementary.join(low.hint("merge"), ["channel_url", "_i"], "left").withColumn(value, F.col(f"_{value}_0"))
    if levels >= LOW:
        wide = over(elementary.select("channel_url", "_b").distinct(), "_b", LOW, levels, LOW)
        found = found.join(wide.hint("merge"), ["channel_url", "_b"], "left").withColumn(value, F.greatest(value, f"_{value}_{LOW}"))
    return found.where(F.col(value).isNotNull()).select("channel_url.channel_url", "start_pos", "end_pos", value)
