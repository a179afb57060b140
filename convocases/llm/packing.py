"""Sum-of-squares packing of token sequences."""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from convocases.llm.bpe import load
from convocases.llm.common import text_of
from convocases.sources.scratch import checkpointed

_NEVER = np.iinfo(np.int64).max

#: Pieces that one task packs together, about.
GROUP = 10_000

#: The pieces of bins with more room than this after a round go into the next round.
ROOM = 16


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the room left in each bin.

    A piece goes where the sum over all gaps of the squared number of open bins with that gap becomes smallest: to an
    open bin whose gap is at least its length, or to a new one. Full bins don't count; on a tie the smaller gap wins.
    Pieces are placed in the order given; longer ones first waste least.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        # A bin of gap g gets gap g - size: two squares change. Only one does where it becomes full or is new.
        change = 2 * (count[: capacity + 1 - size] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[-1] = 2 * count[capacity - size] + 1 if size < capacity else 0
        usable = count[size:] > 0
        usable[-1] = True
        gap = int(np.argmin(np.where(usable, change, _NEVER))) + size
        if gap < capacity:
            at = open_bins[gap].pop()
            count[gap] -= 1
        else:
            at = len(room)
            room.append(capacity)
        bins[i], offsets[i] = at, capacity - room[at]
        room[at] = gap - size
        if gap - size:
            open_bins[gap - size].append(at)
            count[gap - size] += 1
    return bins, offsets, np.array(room, np.int64)


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, uid, and ids (binary, little-endian 32-bit) if asked for.

    A document is its ids and one end id; documents longer than `capacity` are cut into pieces of that many, the last
    shorter. A null or empty text is the end id alone. uid is the number of the task and a running number in it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, close, step = load(path), np.uint32(end).tobytes(), 4 * capacity
        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"].tolist())):
                ids += close
                for n, at in enumerate(range(0, len(ids), step)):
                    own = ids[at:at + step]
                    out.append((doc_id, n, at // 4, len(own) // 4, zlib.crc32(own), uid, own))
                    uid += 1
            found = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "uid", "ids"])
            yield (found if with_ids else found.drop(columns="ids")).astype({"doc_id": "Int64"})

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long" + ", ids binary" * with_ids
    return text_of(docs).mapInPandas(run, kinds)


def _round(items: DataFrame, groups: int, capacity: int, seed: int) -> DataFrame:
    """`items` (uid, length) packed within groups: with bin (the uid of its first item), offset, and room of the bin.

    The number of tasks is given, since adaptive execution would join groups by their few bytes, not by their work.
    """
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        bins, offsets, room = sum_of_squares(batch["length"].to_numpy(), capacity)
        uids = batch["uid"].to_numpy()
        first = uids[np.unique(bins, return_index=True)[1]]
        return pd.DataFrame({"uid": uids, "length": batch["length"], "bin": first[bins], "offset": offsets, "room": room[bins]})

    group = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)).alias("g")
    tasks = min(groups, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = items.select("uid", "length", group).repartition(tasks, "g")
    return dealt.groupBy("g").applyInPandas(run, "uid long, length long, bin long, offset long, room long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, with_ids: bool = True, group: int = GROUP) -> DataFrame:
    """The pieces of `docs` with sequence_id and offset: sequences of at most `capacity` ids, gapless from offset 0.

    Pieces of full length are sequences of their own. The others are dealt by a hash into groups of about `group`, which
    are packed on their own, longest first. Pieces of bins that keep more than ROOM ids of room are taken out again and
    dealt anew, round by round, until they fit in one group or no longer become half as many; so what the borders of
    groups cost does not grow with the corpus. Pieces and rounds are written to the shared folder, as they are read more
    than once. Rows that repeat a doc_id are packed each. An empty table gives no rows.
    """
    cut = checkpointed(pieces(docs, path, capacity, end, with_ids))
    items = cut.where(F.col("length") < capacity).select("uid", "length")
    left, seed, settled = items.count(), 0, None
    while left:
        groups = -(-left // group)
        placed = checkpointed(_round(items, groups, capacity, seed))
        before, seed = left, seed + 1
        items = placed.where(F.col("room") > ROOM).select("uid", "length")
        left = items.count() if groups > 1 else 0
        last = 2 * left > before or not left
        own = placed if last else placed.where(F.col("room") <= ROOM)
        own = own.select(F.col("uid").alias("_uid"), "bin", "offset")
        settled = own if settled is None else settled.unionByName(own)
        left = 0 if last else left
    whole = cut.where(F.col("length") == capacity).withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    if settled is None:
        return whole.drop("uid")
    tails = cut.where(F.col("length") < capacity).join(settled, F.col("uid") == F.col("_uid"))
    tails = tails.withColumn("sequence_id", F.col("bin"))
    return whole.unionByName(tails.select(*whole.columns)).drop("uid")
