"""Merkle manifest of a table: children spread into slot columns give a parent's digest and each child's siblings."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from convocases.sources.scratch import checkpointed

FANOUT = 3

#: Levels that one shuffle brings together; a block of so many levels has FANOUT ** LEVELS nodes at most.
LEVELS = 5

#: Columns of a leaf, in the order in which they are hashed.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left: string, right: string>>"

def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another, each as its length in bytes, a colon and its text, or - for null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with i, the place from 0 on in their group by `order` (nulls first), n, the rows of the group, and g, a
    number of the group that grows in the order of the groups (null first, then by bytes).

    Rows are sorted into ranges and written; a row's place is its place in its range plus the group's rows in the ranges
    before. So a group is as many tasks as it fills, and what meets in a window is one row for each range of a group.
    Equal rows are told apart by where they were read, so they can be cut too.
    """
    keys = [group, *order]
    ranges = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
    placed = checkpointed(ranges.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    flag, value = F.col(group).isNull().alias("_null"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_value")
    counts = placed.groupBy(flag, value, part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_null", "_value")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        "_null", "_value", "_part", (before - F.col("_first")).alias("_start"), F.sum("_n").over(whole).alias("n"), F.min("_first").over(whole).alias("g"))
    joined = placed.select("*", flag, value, part).join(starts, ["_null", "_value", "_part"])
    return joined.select(*[c for c in placed.columns if c != "_at"], (F.col("_start") + F.col("_at")).alias("i"), "n", "g")


def _blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Nodes (g, i, n, digest, ...) with their block, `steps` (left and right siblings of each level) and `top`, the
    digest of the node above them after `levels` levels, or where their group has one node left.

    One shuffle by (g, block) and one sort serve all levels: a level's parents are prefixes of the sort.
    """
    above = [F.floor(F.col("i") / fanout**k).cast("long").alias(f"_p{k}") for k in range(1, levels)]
    rows = nodes.select("*", F.floor(F.col("i") / fanout**levels).cast("long").alias("block"), *above).repartition("g", "block")
    rows = rows.withColumns({"top": F.col("digest"), "steps": F.expr(f"cast(array() as {_STEPS})")})
    for k in range(levels):
        parent = Window.partitionBy("g", "block", *[f"_p{j}" for j in range(levels - 1, k, -1)])
        own = F.floor(F.col("i") / fanout**k) % fanout
        slots = {f"_s{s}": F.max(F.when(own == s, F.col("top"))).over(parent) for s in range(fanout)}
        rows = rows.withColumns(slots)
        more = F.ceil(F.col("n") / fanout**k) > 1  # nodes of the group on this level
        none = F.lit("")
        left = F.concat(*[F.when(own > s, F.coalesce(f"_s{s}", none)).otherwise(none) for s in range(fanout)])
        right = F.concat(*[F.when(own < s, F.coalesce(f"_s{s}", none)).otherwise(none) for s in range(fanout)])
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        whole = F.concat(*[F.coalesce(f"_s{s}", none) for s in range(fanout)])
        rows = rows.withColumns({
            "steps": F.when(more, F.concat("steps", step)).otherwise(F.col("steps")),
            "top": F.when(more, F.sha2(whole.cast("binary"), 256)).otherwise(F.col("top")),
        }).drop(*slots)
    return rows.drop(*[f"_p{k}" for k in range(1, levels)])


def climb(nodes: DataFrame, most: int, crown: Callable[[DataFrame], DataFrame], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """`nodes` (g, i, n, digest, others) with what `crown` adds, and `steps` from the node through its group's root to the crown's.

    `most` is the largest n. Blocks of fanout ** levels nodes become one node each, and these climb on, until each group
    is one node: a row (g, root). `crown` turns such rows into (g, steps, others). On the way back each block meets its
    one node, so no join has a hot key.
    """
    size = fanout**levels
    blocks = _blocks(nodes, fanout, levels)
    tops = blocks.where(F.col("i") % size == 0)
    if most <= size:
        above = crown(tops.select("g", F.col("top").alias("root"))).withColumn("block", F.lit(0).cast("long"))
    else:
        up = checkpointed(tops.select("g", F.col("block").alias("i"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("top").alias("digest")))
        above = climb(up, -(-most // size), crown, fanout, levels).drop("n", "digest").withColumnRenamed("i", "block")
    above = above.withColumnRenamed("steps", "_above")
    joined = blocks.drop("top").join(above, ["g", "block"])
    return joined.withColumn("steps", F.concat("steps", "_above")).drop("_above", "block")


def fold(digest: Column, steps: Column) -> Column:
    """The root that a leaf's digest and the siblings of its levels give."""
    return F.aggregate(steps, digest, lambda x, s: F.sha2(F.concat(s["left"], x, s["right"]).cast("binary"), 256))


def _most(nodes: DataFrame) -> int:
    return nodes.agg(F.max("n")).first()[0] or 0


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, other: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, steps (siblings of each level, from the leaf's to the root's), other.

    `columns` are hashed to a leaf. The first is the id that orders leaves, the second the group whose leaves become one
    subroot; subroots, in the order of their groups (null first, then by bytes), become the root. `other` is a digest
    over `docs` to be held against the root beside the leaf.

    Nulls are hashed as nulls and told from empty texts. Null ids come first in their group. Rows that repeat an id are
    leaves of their own, by digest; wholly equal rows go in any order, which gives the same digests. Columns beyond the
    named ones take no part. In a table of one row the leaf is the root; an empty table gives no rows.
    """
    rows = checkpointed(docs.select(
        docs[columns[0]].cast("long").alias("doc_id"), docs[columns[1]].cast("string").alias("source"),
        leaf_digest([docs[c] for c in columns]).alias("digest"), (F.lit(None).cast("string") if other is None else other).alias("other"),
    ))
    leaves = checkpointed(numbered(rows, "source", ["doc_id", "digest"]).drop("source"))

    def crown(tops: DataFrame) -> DataFrame:
        """Subroots as the leaves of one more tree."""
        one = numbered(tops.select(F.lit("").alias("all"), F.col("g").alias("group"), F.col("root").alias("digest")), "all", ["group"])
        one = checkpointed(one.drop("all"))
        end = lambda top: top.withColumn("steps", F.expr(f"cast(array() as {_STEPS})"))
        return climb(one, _most(one), end, fanout, levels).select(F.col("group").alias("g"), F.col("digest").alias("subroot"), "root", "steps")

    tree = climb(leaves, _most(leaves), crown, fanout, levels)
    return tree.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "steps", "other")


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings on the way to the root."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
