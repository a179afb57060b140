"""Near duplicates: minima of universal hashes, bands, verification, and components by alternating stars."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from convocases.llm.common import text_of
from convocases.sources.scratch import checkpointed

#: Universal hashes, cut into bands of so many rows. Two sets of similarity 0.8 share no band with probability 3e-6.
HASHES, ROWS = 160, 5

#: Four standard deviations of the share of equal minima at a similarity of 0.8: less than that below it is no proof.
SLACK = 4 * (0.8 * 0.2 / HASHES) ** 0.5

#: Rounds in which the members of a bucket are held against one of them, before the prefixes of sets are.
STAR_ROUNDS = 2

_P = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20).integers(0, 2**63, (2, HASHES), dtype=np.uint64) * np.uint64(2) + np.array([[1], [0]], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: `size` words in a row, or all words where there are fewer."""
    words = text.encode().lower().split()  # on bytes: A-Z only, and white space as in SPACE
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    reach = min(size, len(words))
    rolled = np.zeros(len(words) - reach + 1, np.uint64) + np.uint64(reach)
    for k in range(reach):
        rolled = rolled * _P + hashes[k:len(hashes) - reach + 1 + k]
    return np.unique(_mixed(rolled))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of all hash functions a * x + b over each set, upper 32 bits, as rows. Sets are not empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):  # some ten thousand shingles at once stay in the cache
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= 30_000):
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.append(0, np.cumsum([len(s) for s in sets[at:end]])[:-1])
        for i in range(HASHES):
            out[at:end, i] = np.minimum.reduceat(flat * _SEEDS[0, i] + _SEEDS[1, i], starts) >> np.uint64(32)
        at = end
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    bands = signatures.astype(np.uint64).reshape(len(signatures), HASHES // ROWS, ROWS)
    key = np.arange(HASHES // ROWS, dtype=np.uint64)[None, :] + np.uint64(1)
    for i in range(ROWS):
        key = key * _P + bands[:, :, i]
    return _mixed(key).view(np.int64)


def _content(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, content (SHA-256 of the text), n_shingles, digest (of the whole set; null without words), signature (binary)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.iloc[at:at + 500]
                sets = [shingle_set(t, size) for t in batch["text"]]
                full = [s for s in sets if len(s)]
                rows = iter(minima(full)) if full else iter(())
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].array, "content": batch["content"].array, "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "signature": [next(rows).tobytes() if len(s) else None for s in sets],
                })

    texts = text_of(docs).withColumn("content", _content(F.col("text")))
    return texts.mapInPandas(run, "doc_id long, content binary, n_shingles long, digest binary, signature binary")


def _buckets(known: DataFrame) -> DataFrame:
    """key, id: one row for each band of each signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keys = band_keys(np.frombuffer(b"".join(batch["signature"]), np.uint32).reshape(len(batch), HASHES))
                yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(batch["id"].to_numpy(), keys.shape[1])})

    return known.select("id", "signature").mapInPandas(run, "key long, id long")


def _sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """id, shingles (binary) of each of `classes` (id, doc_id, digest), from the text of that doc_id which has the digest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, size).tobytes() for t in batch["text"]]
            own = [xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, batch["digest"])]
            yield pd.DataFrame({"id": batch["id"], "shingles": sets})[np.array(own, bool)]

    return text_of(docs).join(classes, "doc_id").select("id", "digest", "text").mapInPandas(run, "id long, shingles binary")


def _compared(pairs: DataFrame, table: DataFrame, column: str, least) -> DataFrame:
    """The pairs (a, b) for which `least` holds of the two binary values of `column`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [least(x, y) for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    one = table.select(F.col("id").alias("a"), F.col(column).alias("x"))
    two = table.select(F.col("id").alias("b"), F.col(column).alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _linked(pairs: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough; signatures that differ too much spare the look at the sets."""
    floor = int((percent / 100 - SLACK) * HASHES)

    def near(x: bytes, y: bytes) -> bool:
        return int(np.count_nonzero(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32))) >= floor

    def similar(x: bytes, y: bytes) -> bool:
        one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(one, two, assume_unique=True))
        return 100 * both >= percent * (len(one) + len(two) - both)

    return checkpointed(_compared(_compared(pairs, known, "signature", near), sets, "shingles", similar))


def components(edges: DataFrame) -> DataFrame:
    """id, component: of every node of `edges` (a, b), the smallest node it is connected with.

    Large stars and small stars take turns until nothing changes: a node sends its larger neighbours, then its smaller
    ones and itself, to the smallest of all. Minima are aggregated before they meet their edges, and adaptive execution
    splits the joins at nodes with many of them. Each step is written, so the plan stays short.
    """
    def canonical(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = checkpointed(canonical(edges))
    before = None
    while (at := state(now)) != before:
        before = at
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = canonical(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = checkpointed(canonical(small.unionByName(least.select("a", F.col("m").alias("b")))))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _prefix_pairs(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of `placed` (id, component) in different components, among them all whose sets are similar enough.

    Prefix filter: put every set in one order, rare shingles first. Two sets as similar as asked share a shingle among
    the first `size - ceil(percent% of size) + 1` of the larger and the first `size - ceil(2 percent / (100 + percent) of
    size) + 1` of the smaller, at places behind which enough is left of both. Shingles found in one component only come
    first of all and are merely counted. So what many unlinked documents have in common stands behind the prefixes of
    all that have something of their own, and makes no pairs. Components meet by shingle before their members do, so the
    members of one component never meet each other.
    """
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.iloc[at:at + 200]
                if len(batch):
                    sizes = np.array([len(x) // 8 for x in batch["shingles"]])
                    yield pd.DataFrame({
                        "shingle": np.frombuffer(b"".join(batch["shingles"]), np.int64), "id": np.repeat(batch["id"].to_numpy(), sizes),
                        "component": np.repeat(batch["component"].to_numpy(), sizes), "size": np.repeat(sizes, sizes),
                    })

    rows = sets.join(placed, "id").mapInPandas(spread, "shingle long, id long, component long, size long")
    found = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    own = Window.partitionBy("id")
    rank = F.row_number().over(own.orderBy("n", "shingle")) - F.count(F.lit(1)).over(own)
    ranked = rows.join(found.where("lo < hi").select("shingle", "n"), "shingle").withColumn("pos", F.col("size") + rank)
    early = F.expr(f"pos <= size - ceil({2 * percent} * size / {100 + percent}D) + 1")
    prefixes = checkpointed(
        ranked.where(f"pos <= size - ceil({percent} * size / 100D) + 1").select("shingle", "id", "component", "size", "pos", early.alias("early")))
    homes = prefixes.groupBy("shingle", "component").agg(F.max("early").alias("early"))
    one = homes.select("shingle", F.col("component").alias("ca"))
    two = homes.where("early").select("shingle", F.col("component").alias("cb"))
    meet = one.join(two, "shingle").where("ca <> cb")
    larger = prefixes.select("shingle", F.col("component").alias("ca"), F.col("id").alias("a"), F.col("size").alias("m"), F.col("pos").alias("i"))
    smaller = prefixes.where("early").select(
        "shingle", F.col("component").alias("cb"), F.col("id").alias("b"), F.col("size").alias("n"), F.col("pos").alias("j"))
    near = F.expr(f"""(n < m or n = m and b < a) and 100 * n >= {percent} * m
        and {100 + percent} * (1 + least(m - i, n - j)) >= {percent} * (m + n)""")
    return meet.join(larger, ["shingle", "ca"]).join(smaller, ["shingle", "cb"]).where(near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Documents are linked where their sets of word shingles have at least `percent` of their union in common, and a
    component is what links connect; its smallest doc_id stays. Documents with the same set form a class, represented
    by its smallest doc_id, and only representatives go on. Those that share a band are candidates. In the first round
    each member of a bucket is held against the one that shares buckets with most others, as an original does with its
    copies; in further rounds against any other. Once a bucket lies in one component it is done. In the buckets that
    remain, sets of different components that share a shingle in their prefixes are held against each other, by
    signature and then by set, so no link between candidates is lost, and neither within a group of copies nor among
    unlinked documents around a common passage are all pairs made.

    Texts are in lower case (A-Z), words lie between white space; with fewer words than a shingle the whole sequence is
    one. Shingles are compared by 64-bit hashes. Without words or text the set is empty and linked with nothing. Rows
    with a null doc_id are no one's representative. Classes have numbers of their own, so a doc_id that repeats with
    different texts may represent several and lie in several components; all of its rows in a component that it names
    stay. An empty table gives no rows.
    """
    return _verdicts(docs, size, percent, star_rounds).drop("content")


def _verdicts(docs: DataFrame, size: int, percent: int, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """The rows of `near_duplicates` with content, the SHA-256 of the text."""
    signed = checkpointed(signatures(docs, size))
    classes = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    classes = checkpointed(classes.withColumn("id", F.monotonically_increasing_id()))
    known = signed.select("doc_id", "signature", "digest").join(classes, ["doc_id", "digest"]).select("id", "signature")
    known = checkpointed(known.dropDuplicates(["id"]))
    shared = _buckets(known).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    in_buckets = checkpointed(_buckets(known).join(shared, "key"))
    members = checkpointed(in_buckets.groupBy("id").agg(F.sum("n").alias("meets")))
    buckets = checkpointed(in_buckets.drop("n").join(members, "id"))
    sets = checkpointed(_sets(docs, classes.join(members.select("id"), "id"), size).dropDuplicates(["id"]))
    known = checkpointed(known.join(members.select("id"), "id"))

    spark = docs.sparkSession
    found = spark.createDataFrame([], "id long, component long")
    tested = spark.createDataFrame([], "a long, b long")

    def open_buckets(found: DataFrame) -> DataFrame:
        placed = buckets.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        return checkpointed(placed.join(mixed.select("key"), "key"))

    def take(pairs: DataFrame) -> None:
        nonlocal tested, found
        pairs = checkpointed(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"))
        linked = _linked(pairs, known, sets, percent)
        tested = tested.unionByName(pairs)
        if not linked.isEmpty():  # what is connected already stands for its links
            edges = linked.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
            found = checkpointed(components(edges))

    for turn in range(star_rounds):
        left = open_buckets(found)
        if left.isEmpty():
            break
        order = F.xxhash64("id", "key", F.lit(turn)) if turn else -F.col("meets")
        hub = F.min(F.struct(order.alias("order"), "id", "component")).alias("hub")
        hubs = left.groupBy("key").agg(hub).select("key", F.col("hub.id").alias("b"), F.col("hub.component").alias("hub_component"))
        take(left.join(hubs, "key").where("component <> hub_component").select(F.col("id").alias("a"), "b"))
    left = open_buckets(found)
    if not left.isEmpty():
        take(_prefix_pairs(sets, left.select("id", "component").distinct(), percent))

    placed = classes.join(found, "id", "left").select("digest", "doc_id", F.coalesce("component", "id").alias("component"))
    home = placed.join(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("digest", "component_id")
    return signed.select("doc_id", "n_shingles", "digest", "content").join(home, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"), "content",
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, with its columns: rows are told by doc_id (or null) and text."""
    gone = _verdicts(docs, size, percent).where("not kept").select(F.col("doc_id").alias("_gone"), F.col("content").alias("_content")).distinct()
    content = _content(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]) & (content == gone["_content"]), "left_anti")
