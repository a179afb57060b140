"""Repeated byte strings: deep-shallow sorting of the suffixes that share an anchor."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from convocases.sources.scratch import checkpointed

#: Length of the strings, and of the anchors in them.
SIZE, ANCHOR = 200, 40

#: Bytes to which suffixes are sorted by their words; longer common prefixes go to the tries.
SHALLOW = 32

#: Contexts that one sort takes at once, about, and from how many different ones a key is hot.
AT_ONCE, HOT = 10_000, 2_000

#: Windows of a run of a hot key that stay together, from one dealing to the next.
WIDTHS = (40, 8, 1)

#: Bytes of text whose anchors are looked for at once.
_CHUNK = 2_000_000

_P = np.uint64(0x9E3779B97F4A7C15)


def _words(buffer: bytes, order: str) -> np.ndarray:
    """The eight bytes from each place on, as a number; `buffer` has seven more bytes than there are places."""
    return np.ndarray((len(buffer) - 7,), f"{order}u8", buffer, 0, (1,))


def _bit(text: np.ndarray, start: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (text[start + (bit >> 3)] >> (7 - (bit & 7)).astype(np.uint8)) & 1


def _first_bit(x: np.ndarray) -> np.ndarray:
    """Place of the highest set bit of 64-bit numbers that aren't 0, counted from the left."""
    high = (x >> np.uint64(32)).astype(np.int64)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.where(high > 0, 32 - np.frexp(high.astype(float))[1], 64 - np.frexp(low.astype(float))[1])


def deep_shallow(buffer: bytes, starts: np.ndarray, groups: np.ndarray, size: int = SIZE, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `starts` by group and their first `size` bytes, and which of them are equal to another.

    `buffer` has at least `size` + 8 bytes from each start on; `size` and `shallow` are multiples of 8. Multikey
    quicksort splits each group by its median word, first word first, down to `shallow` bytes. What is still together
    goes into a blind trie for each group: a suffix walks down by the bits at which others part, is compared once with
    the leaf it meets, and joins where the two part. All groups take their steps at the same time.
    """
    words = _words(buffer, ">")
    order = np.argsort(groups, kind="stable")
    repeated = np.zeros(len(starts), bool)
    deep: list[tuple[np.ndarray, np.ndarray]] = []  # places in the order and what stands there, by segment

    def split(place: np.ndarray, segment: np.ndarray, depth: np.ndarray) -> None:
        """Sorts the segments (places in the order, segment of each, depth of each in words) to the shallow depth."""
        while len(place):
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            count = np.diff(np.append(first, len(place)))
            word = words[starts[order[place]] + 8 * depth].astype(np.uint64)
            three = np.sort(np.stack([word[first], word[first + count // 2], word[first + count - 1]]), axis=0)[1]
            pivot = np.repeat(three, count)
            key = 3 * np.repeat(np.arange(len(first)), count) + (word == pivot) + 2 * (word > pivot)
            by = np.argsort(key, kind="stable")
            order[place] = order[place][by]
            key = key[by]
            depth = depth + (key % 3 == 1)
            alone = np.bincount(key)[key] < 2
            down = ~alone & (depth >= shallow // 8)
            if down.any():
                deep.append((place[down], key[down]))
            left = ~alone & ~down
            place, segment, depth = place[left], key[left], depth[left]

    own = groups[order]
    together = np.append(own[1:] == own[:-1], False) | np.append(False, own[1:] == own[:-1])
    place = np.flatnonzero(together)
    split(place, own[place], np.zeros(len(place), np.int64))
    text = np.frombuffer(buffer, np.uint8)
    for place, segment in deep:
        _tries(text, words, starts, order, place, segment, size, shallow, repeated)
    return order, repeated


def _tries(text, words, starts, order, place, segment, size, shallow, repeated) -> None:
    """Orders each segment by a blind trie, all tries growing by one suffix a round, and marks equal suffixes."""
    first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    count = np.diff(np.append(first, len(place)))
    member = order[place]
    by_size = np.argsort(-count, kind="stable")
    first, count = first[by_size], count[by_size]
    total = len(place)
    crit, weight = np.zeros(total, np.int64), np.zeros(total, np.int64)
    child = np.zeros((2, total), np.int64)  # nodes from 0 on; ~x is the leaf of suffix number x of the segments
    root = ~first.copy()
    leaf_weight = np.ones(total, np.int64)
    twin = np.full(total, -1, np.int64)
    begin = starts[member]
    steps = 8 * np.arange(shallow // 8, size // 8)
    nodes = 0
    for turn in range(1, int(count[0]) if len(count) else 1):
        tries = np.arange(np.searchsorted(-count, -turn, side="left"))  # those with more members than `turn`
        x = first[tries] + turn
        at = root[tries].copy()
        while (inner := np.flatnonzero(at >= 0)).size:
            at[inner] = child[_bit(text, begin[x[inner]], crit[at[inner]]), at[inner]]
        leaf = ~at
        one, two = words[begin[x][:, None] + steps].astype(np.uint64), words[begin[leaf][:, None] + steps].astype(np.uint64)
        apart = one != two
        word = np.argmax(apart, axis=1)
        rows = np.arange(len(x))
        same = ~apart[rows, word]
        part = np.full(len(x), 8 * size, np.int64)
        new = np.flatnonzero(~same)
        part[new] = 64 * (word[new] + shallow // 8) + _first_bit(one[new, word[new]] ^ two[new, word[new]])
        # Down again to where the suffix joins, counting it on the way.
        at, above, side = root[tries].copy(), np.full(len(x), -1, np.int64), np.zeros(len(x), np.int64)
        walk = np.flatnonzero(at >= 0)
        walk = walk[crit[at[walk]] < part[walk]]
        while walk.size:
            here = at[walk]
            weight[here] += 1
            above[walk], side[walk] = here, _bit(text, begin[x[walk]], crit[here])
            at[walk] = child[side[walk], here]
            walk = walk[at[walk] >= 0]
            walk = walk[crit[at[walk]] < part[walk]]
        old = leaf[same]
        repeated[member[old]] = repeated[member[x[same]]] = True
        leaf_weight[old] += 1
        twin[x[same]] = old
        if new.size:
            node = nodes + np.arange(new.size)
            nodes += new.size
            bit = _bit(text, begin[x[new]], part[new]).astype(np.int64)
            crit[node] = part[new]
            child[bit, node] = ~x[new]
            child[1 - bit, node] = at[new]
            below = at[new]
            weight[node] = 1 + np.where(below >= 0, weight[np.maximum(below, 0)], leaf_weight[np.maximum(~below, 0)])
            top = above[new] < 0
            root[tries[new[top]]] = node[top]
            child[side[new[~top]], above[new[~top]]] = node[~top]
    # From the roots down: a node's first child takes the first places.
    at, spot = root, first.copy()
    spots = np.full(total, -1, np.int64)
    while at.size:
        leaves = at < 0
        spots[~at[leaves]] = spot[leaves]
        at, spot = at[~leaves], spot[~leaves]
        left, right = child[0, at], child[1, at]
        size_left = np.where(left >= 0, weight[np.maximum(left, 0)], leaf_weight[np.maximum(~left, 0)])
        at, spot = np.concatenate([left, right]), np.concatenate([spot, spot + size_left])
    twins = np.flatnonzero(twin >= 0)
    if twins.size:
        twins = twins[np.argsort(twin[twins], kind="stable")]
        of = twin[twins]
        run = np.maximum.accumulate(np.where(np.append(True, of[1:] != of[:-1]), np.arange(len(of)), 0))
        spots[twins] = spots[of] + 1 + np.arange(len(of)) - run
    placed = np.empty(total, np.int64)
    placed[spots] = member
    order[place] = placed


def anchored(texts: list[bytes], size: int = SIZE, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """Runs of windows of `size` bytes with the same anchor: text (number), first window, number of windows, place of
    the anchor from the first window on, key (hash of the anchor), context (hash of all bytes of the windows).

    A window's anchor is the string of `anchor` bytes in it with the smallest hash, the leftmost of several. So equal
    windows, wherever they stand, have equal anchors at equal places.
    """
    reach = size - anchor + 1
    long = [i for i, t in enumerate(texts) if len(t) >= size]
    names = ("text", "first", "windows", "anchor", "key", "context")
    out: dict[str, list] = {n: [] for n in names}
    at = 0
    while at < len(long):
        end, total = at, 0
        while end < len(long) and (end == at or total < _CHUNK):
            total += len(texts[long[end]])
            end += 1
        part = [texts[i] for i in long[at:end]]
        buffer = b"".join(part) + bytes(size + 16)
        words = _words(buffer, "<")
        n = total
        hashes = np.zeros(n, np.uint64)
        for k in range(0, anchor, 8):
            hashes ^= words[k:k + n]
            hashes *= _P
            hashes ^= hashes >> np.uint64(29)
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        span = 1
        while 2 * span <= reach:
            least[:len(least) - span] = np.minimum(least[:len(least) - span], least[span:])
            span *= 2
        rest = reach - span
        if rest:
            least[:len(least) - rest] = np.minimum(least[:len(least) - rest], least[rest:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        lengths = np.array([len(t) for t in part])
        begins = np.append(0, np.cumsum(lengths)[:-1])
        new = np.append(True, place[1:] != place[:-1])
        new[begins] = True
        new[begins + lengths - size + 1] = True  # from here on windows would leave the text
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)
        text = np.searchsorted(begins, first, side="right") - 1
        inside = first <= (begins + lengths - size)[text]
        first, last, text = first[inside], last[inside], text[inside]
        count = last - first
        mark = place[first]
        key = hashes[mark]
        context = (count * 1024 + mark - first).astype(np.uint64) ^ key
        stop = last - 1 + size
        for k in range(0, size, 8):
            context = (context ^ words[first + k]) * _P
            context ^= context >> np.uint64(31)
        for k in range(8, reach + 7, 8):
            context = (context ^ words[stop - k]) * _P
            context ^= context >> np.uint64(31)
        out["text"].append(np.array(long[at:end])[text])
        for name, value in zip(names[1:], (first - begins[text], count, mark - first, (key * _P).view(np.int64), context.view(np.int64))):
            out[name].append(value)
        at = end
    return {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in out.items()}


#: A document is known by two hashes of its id and text, so rows that repeat an id (or have none) don't mix.
_WHO = ["one", "two"]
_WHO_TYPES = "one long, two long"


def _bytes_of(docs: DataFrame) -> DataFrame:
    text, doc_id = F.coalesce(docs["text"].cast("string"), F.lit("")), docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.xxhash64(F.lit(1), text, F.length(text), doc_id).alias("one"), F.xxhash64(F.lit(2), text, doc_id).alias("two"),
        text.cast("binary").alias("data"),
    )


def _runs(rows: DataFrame, size: int, anchor: int, with_place: bool) -> DataFrame:
    """key and context of the runs of windows of all texts; with_place: and the document, first window, and its shape."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.iloc[at:at + 500]
                found = anchored(batch["data"].tolist(), size, anchor)
                if not with_place:
                    yield pd.DataFrame({"key": found["key"], "context": found["context"]})
                    continue
                text = found["text"].astype(np.int64)
                yield pd.DataFrame({
                    "key": found["key"], "context": found["context"], **{n: batch[n].to_numpy()[text] for n in _WHO},
                    "first": found["first"].astype(np.int32), "shape": (1024 * found["windows"] + found["anchor"]).astype(np.int32),
                })

    kinds = "key long, context long" + f", {_WHO_TYPES}, first int, shape int" * with_place
    needed = rows.select(*(_WHO * with_place), "data").where(F.octet_length("data") >= size)
    return needed.mapInPandas(run, kinds)


def _places(lengths: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pieces laid end to end: for each window its piece, its number in it, and its place in the whole."""
    of = np.repeat(np.arange(len(count)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return of, offset, np.repeat(np.cumsum(lengths) - lengths, count) + offset


def _hashed(words: np.ndarray, start: np.ndarray, length: int, state: np.ndarray) -> np.ndarray:
    """`state` mixed with the `length` bytes from each start on, the last eight in any case."""
    for k in (*range(0, length - 7, 8), length - 8):
        state = (state ^ words[start + k]) * _P
        state ^= state >> np.uint64(31)
    return state


def _narrower(pieces: pd.DataFrame, size: int, width: int) -> pd.DataFrame:
    """Runs cut where the anchor's place in the window passes a multiple of `width`, with keys of their own.

    All windows of a part have size - width + 1 bytes around the anchor in common, wherever the part begins and ends. So
    equal windows fall into parts with the same such bytes, which with the old key make the new one.
    """
    count, mark = np.divmod(pieces["shape"].to_numpy().astype(np.int64), 1024)
    of, offset, start = _places(count - 1 + size, count)
    words = _words(b"".join(pieces["piece"]) + bytes(size + 16), "<")
    block = (mark[of] - offset) // width
    new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (block[1:] != block[:-1])))
    count = np.diff(np.append(new, len(of)))
    of, offset, start, block = of[new], offset[new], start[new], block[new]
    mark = mark[of] - offset
    state = pieces["key"].to_numpy().view(np.uint64)[of] + block.astype(np.uint64) * _P
    key = _hashed(words, start + mark - width * block, size - width + 1, state)
    context = _hashed(words, start, size, key ^ (count * 1024 + mark).astype(np.uint64))
    stop = start + count - 1 + size
    for k in range(8, width + 7, 8):
        context = (context ^ words[stop - k]) * _P
        context ^= context >> np.uint64(31)
    whole = pieces.drop(columns="piece").iloc[of].reset_index(drop=True)
    return whole.assign(
        key=key.view(np.int64), context=pd.array(context.view(np.int64), "Int64"), piece=None,
        first=(whole["first"] + offset).astype("int32"), shape=(count * 1024 + mark).astype(np.int32))


def _pieces(texts: DataFrame, size: int) -> DataFrame:
    """For each wanted run of a document the bytes of its windows. A row is a run, so no task holds all runs of many texts."""
    runs = texts.select(*_WHO, "data", F.explode("wanted").alias("w")).select(*_WHO, "data", "w.*")
    length = F.floor(F.col("shape") / 1024).cast("int") - 1 + size
    piece = F.substring("data", F.col("first") + 1, length)
    return runs.select("key", F.lit(None).cast("long").alias("context"), piece.alias("piece"), *_WHO, "first", "shape", "sure", "hot")


def _cut(pieces: DataFrame, size: int, width: int) -> DataFrame:
    """Pieces of hot keys as narrower runs, without bytes."""
    names = ["key", "context", "piece", *_WHO, "first", "shape", "sure"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                yield _narrower(batch.iloc[at:at + 2_000], size, width)[names]

    return pieces.select(*names).mapInPandas(run, f"key long, context long, piece binary, {_WHO_TYPES}, first int, shape int, sure boolean")


def _sorted_repeats(pieces: DataFrame, size: int) -> DataFrame:
    """Stretches of the documents whose windows equal others of the same key, by sorting the suffixes of each key.

    Keys come sorted, so a task holds the contexts of some keys at a time, not its whole partition.
    """
    def stretch(batch: pd.DataFrame) -> pd.DataFrame:
        count, mark = np.divmod(batch["shape"].to_numpy().astype(np.int64), 1024)
        buffer = b"".join(batch["piece"]) + bytes(size + 16)
        of, offset, starts = _places(count - 1 + size, count)
        _, group = np.unique(batch["key"].to_numpy(), return_inverse=True)
        _, repeated = deep_shallow(buffer, starts, group[of] * 1024 + mark[of] - offset, size)
        of, offset = of[repeated], offset[repeated]
        new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(of) else of
        end = np.append(new[1:], len(of)) - 1 if len(of) else of
        begin = batch["first"].to_numpy()[of[new]]
        return pd.DataFrame({
            **{n: batch[n].to_numpy()[of[new]] for n in _WHO},
            "begin": begin + offset[new], "stop": begin + offset[end] + size, "sure": batch["sure"].to_numpy()[of[new]],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < AT_ONCE:
                continue
            whole = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(whole["key"].to_numpy(), whole["key"].iloc[-1]))  # the last key may go on
            if cut:
                yield stretch(whole.iloc[:cut])
            held, rows = [whole.iloc[cut:]], len(whole) - cut
        if rows:
            yield stretch(pd.concat(held, ignore_index=True))

    dealt = pieces.repartition("key").sortWithinPartitions("key", *_WHO)
    found = dealt.drop("context").mapInPandas(run, f"{_WHO_TYPES}, begin int, stop int, sure boolean")
    return found.where(~F.col("sure")).drop("sure")


def repeated_stretches(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, hot: int = HOT, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """one, two (hashes of a document), begin, stop: stretches of bytes covered by repeated strings of `size` bytes.

    Each window of `size` bytes belongs to its anchor, and only one run of windows in eighty bytes or so is dealt out,
    by a hash of the anchor. Equality by hash comes first, as an exact filter: anchors that occur once are done; where
    all runs of an anchor have the same context, all their windows are repeated; of other anchors, contexts that occur
    more than once are. One run of each different context goes on with its bytes to the sort, which tells how far they
    agree. An anchor with more than `hot` different contexts is dealt out anew: its runs are cut into narrower ones,
    known by the bytes that all their windows share, and take the same way, at the last width as single windows.
    Anchors and contexts are told apart by 64 bits of hash each, so runs counted as equal agree in 128.
    """
    rows = _bytes_of(docs)
    stop = (F.col("first") + F.floor(F.col("shape") / 1024) - 1 + size).cast("int").alias("stop")

    def repeated_keys(runs: DataFrame) -> DataFrame:
        seen = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
        return seen.where("n > 1").select("key", (F.col("lo") != F.col("hi")).alias("mixed"))

    runs = _runs(rows, size, anchor, True).withColumn("sure", F.lit(False))
    keys = checkpointed(repeated_keys(_runs(rows, size, anchor, False)))
    found = []
    for width in (*widths, None):
        runs = checkpointed(runs.join(keys, "key"))
        mixed = runs.where("mixed")
        contexts = checkpointed(
            mixed.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_WHO, "first", "shape", "sure")).alias("at"))
        )
        several = mixed.join(contexts.where("n > 1").select("key", "context"), ["key", "context"])
        whole = runs.where("not mixed").drop("mixed").unionByName(several.drop("mixed")).where("not sure")
        found.append(whole.select(*_WHO, F.col("first").alias("begin"), stop))
        many = (F.count(F.lit(1)) > hot) if width else F.lit(False)
        hot_keys = contexts.groupBy("key").agg(many.alias("hot")).where("hot")
        sure = (F.col("at.sure") | (F.col("n") > 1)).alias("sure")
        wanted = contexts.join(hot_keys, "key", "left").select(
            "at.one", "at.two", F.struct("key", "at.first", "at.shape", sure, F.coalesce("hot", F.lit(False)).alias("hot")).alias("w"))
        wanted = wanted.groupBy(*_WHO).agg(F.collect_list("w").alias("wanted"))  # as long as the document at most
        texts = rows.select(*_WHO, "data").join(wanted, _WHO).dropDuplicates(_WHO)
        pieces = checkpointed(_pieces(texts.select(*_WHO, "data", "wanted"), size))
        found.append(_sorted_repeats(pieces.where("not hot").drop("hot"), size))
        hot_pieces = pieces.where("hot")
        if width is None or hot_pieces.isEmpty():
            break
        runs = checkpointed(_cut(hot_pieces, size, width).drop("piece"))
        keys = repeated_keys(runs)
    return reduce(DataFrame.unionByName, found)


def drop_repeats(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, hot: int = HOT, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept (binary): the text in UTF-8 without the bytes
    that a string of `size` bytes covers which also starts anywhere else, in the same document or another.

    A null or empty text has no bytes; texts shorter than `size` stay whole. Null and repeated ids stand for themselves:
    a document is known by 128 bits of hash of its id and text. Rows that repeat a doc_id and its text
    repeat each other; so do copies with other ids. An empty table gives no rows.
    """
    gone = repeated_stretches(docs, size, anchor, hot, widths).groupBy(*_WHO).agg(F.collect_list(F.struct("begin", "stop")).alias("gone"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, data, gone in zip(batch["doc_id"], batch["data"], batch["gone"]):
                kept, removed, spans = data, 0, 0
                if gone is not None and len(gone):
                    edge = np.zeros(len(data) + 1, np.int32)
                    at = np.array([(g["begin"], g["stop"]) for g in gone])
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at[:, 1], -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                    removed = len(data) - len(kept)
                    spans = int(np.count_nonzero(covered[1:] & ~covered[:-1]) + covered[0])
                out.append((doc_id, len(data), removed, spans, kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    joined = _bytes_of(docs).join(gone, _WHO, "left")
    return joined.select("doc_id", "data", "gone").mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
