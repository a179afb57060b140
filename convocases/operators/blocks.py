"""Ordered work and joins for groups of any size.

A window over a channel puts the whole channel into one task. Here a group that is too large is cut into
blocks at sampled sort keys: windows run per (group, block), one small row per block carries the running
state over the block borders, and the results equal those of one window over the whole group. Where no
group is too large nothing is cut and the plan is a plain window: one exchange and one sort.
"""

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

ROWS_PER_BLOCK = 2_000_000
SAMPLES_PER_BLOCK = 64
MAX_CUTS = 100_000
MAX_GLOBAL_CUTS = 1_000
#: Cuts that a row looks at in one step, less one: those of a larger group are found through a tree of such lists.
FAN = 64
BLOCK = "_block"
SPLIT = "_split"


class Cuts(NamedTuple):
    rows: list
    schema: T.StructType


class Ordered(NamedTuple):
    rows: DataFrame
    keys: list[str]
    order: list[str]
    split: bool
    null_keys: bool = False  # whether a group with a null in its key is cut


class Step(NamedTuple):
    kind: str
    value: Column | None = None


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK
) -> Cuts:
    """Sort keys at which groups larger than about `rows_per_block` are cut; none for smaller groups.

    Reads the key columns once and keeps one in `rows_per_block / 64` of the rows, by hash. The list that
    comes to the driver holds at most rows / rows_per_block entries; beyond `MAX_CUTS` the blocks grow. Small blocks may
    come to that, so for them the rows are counted first: then the sample, too, stays below 64 rows for each cut.
    Any choice of cuts gives right results, they only balance the work.
    """
    limit = MAX_CUTS if keys else MAX_GLOBAL_CUTS
    sample = df.select(*keys, *order)
    if rows_per_block < SAMPLES_PER_BLOCK ** 2:
        rows_per_block = max(rows_per_block, -(-sample.count() * 5 // (limit * 4)))  # a fifth is left for chance
    step = max(1, rows_per_block // SAMPLES_PER_BLOCK)
    every = max(1, rows_per_block // step)
    schema = sample.schema
    if step > 1:
        sample = sample.where(F.pmod(F.xxhash64(*keys, *order), F.lit(step)) == 0)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = sample.withColumn("_rank", rank)
    while True:
        at_cut = (F.col("_rank") > 1) & ((F.col("_rank") - 1) % every == 0)
        rows = ranked.where(at_cut).drop("_rank").limit(limit + 1).collect()
        if len(rows) <= limit:
            return Cuts(rows, schema)
        every *= 2


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> Ordered:
    """Give every row its block number inside its group."""
    keys, order = list(keys), list(order)
    if cuts is None:
        cuts = find_cuts(df, keys, order, rows_per_block)
    if not cuts.rows:
        return Ordered(df, keys, order, False)
    here = F.struct(*order)
    if keys:
        df = find_block(df, keys, order, cuts)
    else:
        points = [F.struct(*(F.lit(r[c]).cast(cuts.schema[c].dataType).alias(c) for c in order)) for r in cuts.rows]
        df = df.withColumns({BLOCK: cuts_upto(F.sort_array(F.array(*points)), here, len(cuts.rows)), SPLIT: F.lit(True)})
    return Ordered(df, keys, order, True, any(r[k] is None for r in cuts.rows for k in keys))


def cuts_upto(bounds: Column, here: Column, longest: int) -> Column:
    """Number of the sorted `bounds` (null: none) at or before `here`, by binary search."""
    strides = [1 << i for i in reversed(range(longest.bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, strides)), F.lit(0),
        lambda at, stride: F.when(F.get(bounds, at + stride - 1) <= here, at + stride).otherwise(at),
    )


def find_block(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    """The number of its group's cuts at or before each row, and whether its group has any.

    A row carries the list it searches, so no list has more than FAN - 1 cuts: the cuts of a group make a tree, in which
    a row goes down from every FAN^h-th cut to single ones. Groups with few cuts need one step.
    """
    # Bounded by MAX_CUTS entries, so it fits a broadcast at any data size.
    table = df.sparkSession.createDataFrame(cuts.rows, cuts.schema)
    numbered = table.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    longest = max(Counter(tuple(r[k] for k in keys) for r in cuts.rows).values())
    unit = 1
    while unit * FAN <= longest:
        unit *= FAN
    df = df.withColumns({BLOCK: F.lit(0), SPLIT: F.lit(False)})
    while unit:
        above = unit * FAN
        some = numbered.where((F.col("_n") % unit == 0) & (F.col("_n") % above != 0))
        lists = some.groupBy(*keys, (F.col("_n") - F.col("_n") % above).alias(BLOCK)).agg(
            F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))
        df = left_join_null_safe(df, F.broadcast(lists), [*keys, BLOCK])
        df = df.withColumns({
            BLOCK: F.col(BLOCK) + unit * cuts_upto(F.col("_cuts"), F.struct(*order), min(longest, FAN - 1)),
            SPLIT: F.col(SPLIT) | F.col("_cuts").isNotNull(),
        }).drop("_cuts")
        unit //= FAN
    return df


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys match; the key columns are those of the left side."""
    names = {k: f"_right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()))
    return left.join(renamed, same, "left").drop(*names.values())


def by_place(df: DataFrame, keys: Sequence[str], order: str, place: Column, length: Column, any_long: bool) -> Ordered:
    """Blocks of groups whose rows carry their 1-based `place` and the group's `length`: no sampling.

    `any_long` says whether any group exceeds a block; the caller can tell from the lengths.
    """
    if not any_long:
        return Ordered(df, list(keys), [order], False)
    rows = df.withColumns({
        BLOCK: F.floor((place - 1) / ROWS_PER_BLOCK).cast("int"), SPLIT: length > ROWS_PER_BLOCK,
    })
    return Ordered(rows, list(keys), [order], True)


def scan(o: Ordered, **steps: Step) -> Ordered:
    """Add running columns in group order. Kinds of step:

    row_number; lag(value), lead(value): of the row before, after; last(value): last non-null before this row;
    sum(value), max(value): up to and with this row; count, least(value), total(value): over the whole group.
    """
    group = Window.partitionBy(*o.keys, *([BLOCK] if o.split else []))
    ordered = group.orderBy(*o.order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    inside = {
        "row_number": lambda v: F.row_number().over(ordered).cast("long"),
        "lag": lambda v: F.lag(v).over(ordered),
        "lead": lambda v: F.lead(v).over(ordered),
        "last": lambda v: F.last(v, ignorenulls=True).over(before),
        "sum": lambda v: F.sum(v).over(upto),
        "max": lambda v: F.max(v).over(upto),
        "count": lambda v: F.count(F.lit(1)).over(group),
        "least": lambda v: F.min(v).over(group),
        "total": lambda v: F.sum(v).over(group),
    }
    if not o.split:
        return o._replace(rows=o.rows.withColumns({n: inside[s.kind](s.value) for n, s in steps.items()}))

    place = F.struct(*o.order)
    per_block = {
        "row_number": lambda v: F.count(F.lit(1)),
        "lag": lambda v: F.max_by(v, place),
        "lead": lambda v: F.min_by(v, place),
        "last": lambda v: F.max_by(v, F.when(v.isNotNull(), place)),
        "sum": lambda v: F.sum(v),
        "max": lambda v: F.max(v),
        "count": lambda v: F.count(F.lit(1)),
        "least": lambda v: F.min(v),
        "total": lambda v: F.sum(v),
    }
    blocks = Window.partitionBy(*o.keys)
    earlier = blocks.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "row_number": lambda t: F.sum(t).over(earlier),
        "lag": lambda t: F.lag(t).over(blocks.orderBy(BLOCK)),
        "lead": lambda t: F.lead(t).over(blocks.orderBy(BLOCK)),
        "last": lambda t: F.last(t, ignorenulls=True).over(earlier),
        "sum": lambda t: F.sum(t).over(earlier),
        "max": lambda t: F.max(t).over(earlier),
        "count": lambda t: F.sum(t).over(blocks),
        "least": lambda t: F.min(t).over(blocks),
        "total": lambda t: F.sum(t).over(blocks),
    }

    def joined(kind, name):
        own, carry = F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        if kind in ("row_number", "sum"):
            return F.when(own.isNull(), carry).otherwise(own + F.coalesce(carry, F.lit(0)))
        if kind == "lag":
            return F.when(F.col("_scan_row") == 1, carry).otherwise(own)
        if kind == "lead":
            return F.when(F.col("_scan_next").isNull(), carry).otherwise(own)
        if kind == "last":
            return F.coalesce(own, carry)
        if kind == "max":
            return F.greatest(own, carry)
        return F.coalesce(carry, own)

    totals = (
        o.rows.where(F.col(SPLIT)).groupBy(*o.keys, BLOCK)
        .agg(*(per_block[s.kind](s.value).alias(f"_carry_{n}") for n, s in steps.items()))
    )
    carry = totals.select(
        *o.keys, BLOCK, *(carried[s.kind](F.col(f"_carry_{n}")).alias(f"_carry_{n}") for n, s in steps.items())
    )
    rows = o.rows.withColumns({
        "_scan_row": F.row_number().over(ordered), "_scan_next": F.lead(F.lit(True)).over(ordered),
        **{f"_in_{n}": inside[s.kind](s.value) for n, s in steps.items()},
    })
    # Rows already lie by (group, block); only the small carry table moves, unless a null group has to match too.
    at = [*o.keys, BLOCK]
    rows = left_join_null_safe(rows, carry, at) if o.null_keys else rows.join(carry, at, "left")
    rows = rows.withColumns({n: joined(s.kind, n) for n, s in steps.items()})
    return o._replace(rows=rows.drop("_scan_row", "_scan_next", *(f"_{p}_{n}" for p in ("in", "carry") for n in steps)))


def finish(o: Ordered) -> DataFrame:
    return o.rows.drop(BLOCK, SPLIT)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = ROWS_PER_BLOCK) -> list:
    """Keys held by about `hot_rows` rows or more, from a sample, with the number of shares to deal them into.

    At most rows / hot_rows keys can qualify; of more than `MAX_CUTS` the hottest are dealt out.
    """
    step = max(1, hot_rows // SAMPLES_PER_BLOCK)
    sample = df.select(*keys)
    if step > 1:
        sample = sample.sample(fraction=1.0 / step, seed=7)
    counts = sample.groupBy(*keys).agg((F.count(F.lit(1)) * step).alias("_rows")).where(F.col("_rows") >= hot_rows)
    shares = F.ceil(F.col("_rows") / hot_rows).cast("int") + 1
    return counts.select(*keys, shares.alias("_shares")).orderBy(F.desc("_shares")).limit(MAX_CUTS).collect()


def join_spread(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
    spread: Sequence[str] = (), hot_rows: int = ROWS_PER_BLOCK, hot: list | None = None,
) -> DataFrame:
    """Equi-join whose left side may hold a hot key: hot keys are dealt into shares by the `spread` columns.

    Callers that know the sizes of keys hand in `hot`, rows of keys and `_shares`, which spares a pass over the left side.

    Only the right rows of hot keys are copied, once per share. The right side may grow with the data and is never
    broadcast, however small its compressed files look. `spread` has to tell the rows of one key
    apart and must not change when a task is run again; the default is every other left column that can be hashed.
    """
    keys = list(keys)
    added = [] if how == "left_semi" else [c for c in right.columns if c not in keys]
    hot = hot_keys(left, keys, hot_rows) if hot is None else hot
    if not hot:
        return left.join(right.hint("merge"), keys, how).select(*left.columns, *added)
    spark = left.sparkSession
    schema = T.StructType([*(left.schema[k] for k in keys), T.StructField("_shares", T.IntegerType())])
    names = {k: f"_hot_{k}" for k in keys}
    # Bounded by MAX_CUTS rows.
    table = F.broadcast(spark.createDataFrame(hot, schema).withColumnsRenamed(names))

    def with_shares(df):
        same = reduce(and_, (df[k].eqNullSafe(F.col(name)) for k, name in names.items()))
        return df.join(table, same, "left").drop(*names.values())

    hashable = [c for c, kind in left.dtypes if c not in keys and "map<" not in kind and "variant" not in kind]
    spread = list(spread) or hashable or keys
    share = F.when(F.col("_shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("_shares")))
    dealt = with_shares(left).withColumn("_share", share.cast("int")).drop("_shares")
    copies = with_shares(right).withColumn(
        "_share", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1))
    ).drop("_shares")
    return dealt.join(copies.hint("merge"), [*keys, "_share"], how).select(*left.columns, *added)
