"""Fill in the middle: texts cut at two ranks of lines, found in an indexable skip list."""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Of 100 texts so many are transformed, and of 100 of those so many have their suffix first.
RATE, SUFFIX_FIRST, SEED = 100, 50, 7

#: A tower of the skip list rises by a lane with one chance in four.
_BITS = 2

#: Characters of text that are cut at once.
AT_ONCE = 4_000_000

_P = np.uint64(0x9E3779B97F4A7C15)


class Lane(NamedTuple):
    """Links of one lane, texts end to end: units and code points that a link passes over, and its tower in the lane below."""

    units: np.ndarray
    points: np.ndarray
    down: np.ndarray


def units_of(text: str) -> list[int]:
    """Code points of the lines of a text, their line feeds included."""
    pieces = [len(x) + 1 for x in text.split("\n")]
    pieces[-1] -= 1
    return pieces if pieces[-1] else pieces[:-1]


def skip_list(points: np.ndarray, counts: np.ndarray) -> list[Lane]:
    """Lanes from the lowest, a link for each unit, to the highest, one link for each text.

    `points` are the widths of all units, `counts` (none is 0) the units of each text. The first tower of a text takes
    part in every lane; the height of another follows from a hash of its rank, so a task that runs again builds the same.
    """
    heads = np.cumsum(counts) - counts
    rank = np.arange(len(points), dtype=np.uint64) - np.repeat(heads, counts).astype(np.uint64)
    mixed = (rank + np.uint64(1)) * _P
    mixed ^= mixed >> np.uint64(32)
    mixed *= _P
    bits = (mixed & (~mixed + np.uint64(1))).astype(float)  # the lowest set bit
    height = np.where(bits > 0, np.frexp(bits)[1] - 1, 64) // _BITS
    height[heads] = 64
    lanes = [Lane(np.ones(len(points), np.int64), points.astype(np.int64), np.arange(len(points)))]
    while len(lanes[-1].units) > len(counts):
        tall = np.flatnonzero(height >= len(lanes))
        height = height[tall]
        lanes.append(Lane(np.add.reduceat(lanes[-1].units, tall), np.add.reduceat(lanes[-1].points, tall), tall))
    return lanes


def descend(lanes: list[Lane], text: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Code points before unit number `rank` of each of the texts asked for, which may be its number of units.

    All searches go right while the units passed stay within their rank, and down a lane otherwise, adding up both widths.
    """
    at, units, points = text.copy(), np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    for lane in reversed(lanes):
        go = np.flatnonzero(units < rank)
        while go.size:
            go = go[units[go] + lane.units[at[go]] <= rank[go]]
            units[go] += lane.units[at[go]]
            points[go] += lane.points[at[go]]
            at[go] += 1
            go = go[units[go] < rank[go]]
        left = units < rank
        at[left] = lane.down[at[left]]
    return points


def cut(texts: list[str], low: np.ndarray, high: np.ndarray, units: list[list[int]]) -> list[tuple[str, str, str]]:
    """Prefix, middle and suffix of texts with units, after `low` and `high` of them."""
    counts = np.array([len(u) for u in units])
    lanes = skip_list(np.fromiter((p for u in units for p in u), np.int64, counts.sum()), counts)
    number = np.arange(len(texts))
    borders = descend(lanes, np.concatenate([number, number]), np.concatenate([low, high])).reshape(2, -1).T.tolist()
    return [(t[:a], t[a:b], t[b:]) for t, (a, b) in zip(texts, borders)]


def numbers(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transformed(ids: list[int | None], texts: list[str], rate: int, suffix_first: int, seed: int) -> dict[str, list]:
    """Columns of `fill_in_middle` for some documents."""
    size = len(texts)
    units, drawn = [units_of(t) for t in texts], [numbers(seed, i) for i in ids]
    out = {"n": [len(u) for u in units], "form": ["plain"] * size, "prefix_chars": [None] * size, "middle_chars": [None] * size, "output": list(texts)}
    open_ = [i for i, t in enumerate(texts) if t and drawn[i][2] % 100 < rate and not any(x in t for x in (PREFIX, SUFFIX, MIDDLE))]
    if open_:
        ranks = np.sort([[h % (len(units[i]) + 1) for h in drawn[i][:2]] for i in open_], axis=1)
        parts = cut([texts[i] for i in open_], ranks[:, 0], ranks[:, 1], [units[i] for i in open_])
        for i, (prefix, middle, suffix) in zip(open_, parts):
            first = drawn[i][3] % 100 < suffix_first
            out["form"][i] = "spm" if first else "psm"
            out["prefix_chars"][i], out["middle_chars"][i] = len(prefix), len(middle)
            head = f"{SUFFIX}{suffix}{PREFIX}{prefix}" if first else f"{PREFIX}{prefix}{SUFFIX}{suffix}"
            out["output"][i] = f"{head}{MIDDLE}{middle}"
    return out


def fill_in_middle(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, n (lines), form (plain, psm, spm), prefix_chars, middle_chars, output.

    A text is cut after two numbers of lines drawn from its doc_id; the piece between them is the middle. Empty texts,
    and texts that hold one of the three marks, stay plain; so does a text whose third number falls outside `rate`.
    A null text counts as empty; a null doc_id draws as an empty one, and repeated ids draw the same numbers. Rows stay
    where they are, so no key gathers. An empty table gives no rows.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch["doc_id"].to_pylist(), 0
            while at < len(batch):
                end, size, texts = at, 0, []
                while end < len(batch) and (size < AT_ONCE or end == at):
                    texts.append(batch["text"][end].as_py())
                    size += len(texts[-1])
                    end += 1
                yield pa.RecordBatch.from_pydict({"doc_id": ids[at:end], **transformed(ids[at:end], texts, rate, suffix_first, seed)}, kinds)
                at = end

    return text_of(docs).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text as it was, from an output and its form alone. No text that was cut holds a mark, so the first of each is ours."""
    second = f"if({form} = 'psm', '{SUFFIX}', '{PREFIX}')"
    mark = len(PREFIX)
    one = f"substr({output}, {mark + 1}, locate({second}, {output}, {mark + 1}) - {mark + 1})"
    two = (f"substr({output}, locate({second}, {output}, {mark + 1}) + {mark},"
           f" locate('{MIDDLE}', {output}) - locate({second}, {output}, {mark + 1}) - {mark})")
    middle = f"substr({output}, locate('{MIDDLE}', {output}) + {mark})"
    return F.expr(f"case {form} when 'plain' then {output} when 'psm' then concat({one}, {middle}, {two}) else concat({two}, {middle}, {one}) end")
