"""URL filters: rules as intervals of canonical keys, met by a sorted sweep that keeps a stack of nested rules."""

from pyspark.sql import Column, DataFrame, functions as F, Window

from convocases.sources.scratch import checkpointed

#: Points that one window of the sweep handles, about, and the most windows before they grow with the input.
BLOCK_ROWS, MAX_PARTS = 5_000, 20_000

#: The most sampled keys that cut the sort order into blocks; blocks that are too large all the same are salted.
MAX_CUTS = 2_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty for null and where there is no `://`."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot behind it: a domain's key is a prefix of its subdomains' keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _prefix_depth(rules: DataFrame, group: str, key: str) -> DataFrame:
    """`rules` with depth: how many rules of the same group have a key that is a proper prefix of theirs.

    Every rule looks up its own prefixes, so the work is the total length of the keys, not pairs of rules.
    """
    own = rules.select(group, key).distinct()
    prefixes = own.select(
        group, F.col(key).alias("_full"), F.explode(F.expr(f"transform(sequence(0, length({key})), i -> substring({key}, 1, i))")).alias(key),
    ).where(F.col(key) != F.col("_full"))
    above = prefixes.join(own, [group, key]).groupBy(group, F.col("_full").alias(key)).agg(F.count(F.lit(1)).cast("int").alias("depth"))
    return own.join(above, [group, key], "left").select(group, key, F.coalesce("depth", F.lit(0)).alias("depth"))


def _from(key: Column) -> Column:
    return key.cast("binary")


def _until(key: Column) -> Column:
    """Sorts behind all keys with this prefix: no UTF-8 text has the byte FF."""
    return F.concat(key.cast("binary"), F.lit(b"\xff"))


def stab(points: DataFrame, rules: DataFrame, group: str, key: str, out: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`points` with an array `out` of the rule keys that are prefixes of their key, the outermost first.

    A prefix is the interval of the keys that start with it, so the rules of a group are nested or apart. Points and
    borders are sorted together; an opening border puts its rule on the stack at its depth, a closing one takes it off,
    and a point sees the stack as it stands. The stack is one running column per depth. Blocks of the sort order, cut
    at sampled keys, are swept on their own, and a block with more points than `block_rows` is dealt out by a hash;
    each block and part gets the rules that are open in it. `points` is read four times, so hand in a written
    table; it must not have a column named like these: _at, _kind, _row, _rule.
    """
    depths = _prefix_depth(rules, group, key)
    levels = (depths.agg(F.max("depth")).first()[0] or 0) + 1  # bounded by the longest chain of nested rules
    total = points.count()
    block_rows = max(block_rows, total // MAX_PARTS)
    wanted = min(MAX_CUTS, total // block_rows)
    cuts: list[tuple[str, str]] = []
    if wanted:
        sample = sorted(
            (tuple(r) for r in points.select(group, key).sample(min(1.0, 20 * wanted / total), seed=7).collect()),
            key=lambda r: (r[0].encode(), r[1].encode()),
        )
        cuts = sorted({sample[i * len(sample) // (wanted + 1)] for i in range(1, wanted + 1)} if sample else ())
    table = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(k.encode()).alias("k")) for g, k in cuts])
    strides = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def block(at: Column) -> Column:
        """Cuts at or before this place, by binary search."""
        here = F.struct(F.col(group).alias("g"), at.alias("k"))
        further = lambda n, stride: F.when(F.get(table, n + stride - 1) <= here, n + stride).otherwise(n)
        return F.aggregate(strides, F.lit(0), further) if cuts else F.lit(0)

    placed = points.withColumn("_block", block(_from(F.col(key))))
    sizes = placed.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_parts"))
    row = F.struct(*[placed[c] for c in points.columns])
    mixed = placed.join(F.broadcast(sizes), "_block").select(
        "_block", F.pmod(F.xxhash64(*points.columns), F.col("_parts")).cast("int").alias("_part"), group,
        _from(F.col(key)).alias("_at"), F.lit(2).alias("_kind"), F.lit(None).cast("int").alias("depth"),
        F.lit(None).cast("string").alias("_rule"), row.alias("_row"),
    )
    borders = (
        depths.withColumn("_block", F.explode(F.sequence(block(_from(F.col(key))), block(_until(F.col(key))))))
        .join(F.broadcast(sizes), "_block").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("_b", F.explode(F.array(
            F.struct(_from(F.col(key)).alias("_at"), F.lit(1).alias("_kind")),
            F.struct(_until(F.col(key)).alias("_at"), F.lit(0).alias("_kind")),
        )))
        .select("_block", "_part", group, "_b.*", "depth", F.col(key).alias("_rule"))
    )
    sweep = Window.partitionBy("_block", "_part", group).orderBy("_at", "_kind", "depth").rowsBetween(Window.unboundedPreceding, 0)
    stack = [
        F.last(F.when(F.col("depth") == d, F.struct(F.when(F.col("_kind") == 1, F.col("_rule")).alias("rule"))), ignorenulls=True)
        .over(sweep).alias(f"_s{d}")
        for d in range(levels)
    ]
    seen = mixed.unionByName(borders, allowMissingColumns=True).select("_kind", "_row", *stack).where("_kind = 2")
    active = F.filter(F.array(*[F.col(f"_s{d}.rule") for d in range(levels)]), lambda x: x.isNotNull())
    return seen.select("_row.*", active.alias(out))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict.

    `rules` has host, path, verdict. A rule fits its host and all subdomains where the path starts with the rule's; the
    longest host and path together wins, then the longer host; of rules with the same host and path a block wins. Where
    none fits, rule is null and the verdict `default`. The paths are stabbed first, then the hosts once for each rule
    path found, so a url has as many rows in the second sweep as there are nested rule paths around its path. Both
    sweeps see each pair of host and path once; those pairs, the rules and the
    first sweep are written to the shared folder. A url that is null or lacks `://` has empty host and path. Rows that
    repeat a page_id are judged each. Empty tables, of pages or rules, are fine.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    places = checkpointed(urls.select("host", "path").distinct())
    known = checkpointed(rules.select("host", "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.lit("*").alias("scope"), F.col("path").alias("rule_path"), host_key(F.col("host")).alias("rule_key"),
        F.col("host").alias("rule_host"), "verdict"))
    by_path = stab(places.select(F.lit("*").alias("scope"), "host", F.col("path").alias("rule_path")),
                   known.select("scope", "rule_path").distinct(), "scope", "rule_path", "paths", block_rows)
    asked = checkpointed(by_path.select("host", F.col("rule_path").alias("path"), F.explode("paths").alias("rule_path")).withColumn(
        "rule_key", host_key(F.col("host"))))
    found = stab(asked, known.select("rule_path", "rule_key"), "rule_path", "rule_key", "keys", block_rows)
    hits = found.where(F.size("keys") > 0).select("host", "path", "rule_path", F.element_at("keys", -1).alias("rule_key"))
    name = F.concat("rule_host", "rule_path")
    best = hits.join(known, ["rule_path", "rule_key"]).groupBy("host", "path").agg(F.max(
        F.struct(F.length(name).alias("length"), F.length("rule_host").alias("host_length"), "verdict", name.alias("rule"))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
