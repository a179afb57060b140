"""Secrets in parts: identifiers, secrets and endpoints are proposed alone and linked within their scopes."""

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import text_of

#: Farthest start of a complementary part from a part's own, in code points, and the least bits for each character of an opaque value.
REACH, BITS = 400, 3.5

#: Characters of text whose parts are joined at once.
AT_ONCE = 4_000_000

IDENTIFIER, SECRET, ENDPOINT = 1, 2, 4

#: What completes a credential: an identifier or an endpoint wants a secret, a secret wants one of them.
WANTS = {IDENTIFIER: SECRET, SECRET: IDENTIFIER | ENDPOINT, ENDPOINT: SECRET}


def _opaque(m: re.Match) -> bool:
    """Capitals, small letters and digits, about as mixed as a random value of its length."""
    x = m[0]
    if not (re.search("[A-Z]", x) and re.search("[a-z]", x) and re.search("[0-9]", x)):
        return False
    return -sum(n / len(x) * math.log2(n / len(x)) for n in Counter(x).values()) >= BITS


@dataclass(frozen=True)
class Kind:
    """A part: pattern, check of a match, role in a credential (0: none), and whether it counts only with a complement.

    A text whose ASCII letters in lower case hold none of `hints` has no match.
    """

    name: str
    pattern: re.Pattern
    role: int
    weak: bool = False
    valid: Callable[[re.Match], bool] = lambda m: True
    hints: tuple[str, ...] = ()


#: The base kinds in the order of the digest.
BASE = (
    Kind("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), SECRET,
         valid=lambda m: len(m[2]) >= 8, hints=("passw", "secret", "token", "apikey", "api_key")),
    Kind("access", re.compile("AKIA[A-Z0-9]+"), IDENTIFIER, valid=lambda m: len(m[0]) >= 16, hints=("akia",)),
    Kind("hex", re.compile("[0-9a-f]{32,}"), SECRET),  # shorter runs fail
)

#: What is looked for beyond them: complete credentials, then parts.
MORE = (
    Kind("private_key", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:\s+[A-Za-z0-9+/=]{16,})*+(?:(?:\s+[A-Za-z0-9+/=]+)?\s*-----END [A-Z ]{0,40}PRIVATE KEY-----)?"),
         0, hints=("private key-----",)),
    Kind("signed_token", re.compile(r"eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{10,}"), 0, hints=("eyj",)),
    Kind("login_url", re.compile(r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{3,100}@[A-Za-z0-9.-]+(?::[0-9]+)?"), 0, hints=("://",)),
    Kind("account", re.compile(
        r"""(?<![A-Za-z0-9])(?ai:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|(?:access_?)?key_?id|tenant_?id)["']?[\x20]*[:=]\x20*["']?([A-Za-z0-9@._+-]+)"""),
         IDENTIFIER, True, lambda m: len(m[1]) >= 3, ("user", "login", "account", "client", "key", "tenant")),
    Kind("labelled", re.compile(
        r"""(?<![A-Za-z0-9])(?ai:password|passwd|passphrase|pwd|pass|secret|token|api_?key|secret_?(?:access_?)?key|client_?secret|credential)["']?\x20*[:=]\x20*["']?([!-~]+)"""),
         SECRET, True, lambda m: len(m[1].strip("\"',;")) >= 4, ("pass", "pwd", "secret", "token", "key", "credential")),
    Kind("opaque", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"), SECRET, True, _opaque),
    Kind("endpoint", re.compile(
        r"""(?<![A-Za-z0-9])(?ai:host(?:_?name)?|server|endpoint|(?:base_?)?url|dsn|database|bucket|region)["']?\x20*[:=]\x20*["']?([A-Za-z0-9][A-Za-z0-9:/._?&=%-]{2,})"""),
         ENDPOINT, True, hints=("host", "server", "endpoint", "url", "dsn", "database", "bucket", "region")),
    Kind("service", re.compile(r"(?<![A-Za-z0-9.-])(?:[A-Za-z][A-Za-z0-9+.-]{1,20}://)?(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}:[0-9]{2,5}(?![0-9])"), ENDPOINT, True, hints=(":",)),
)
KINDS = BASE + MORE

_BLOCK = re.compile(r"\n[\x20\t\r]*\n")


def proposed(text: str) -> list[tuple[int, int, int]]:
    """Parts as (start, number of the kind, end), by start. Of kinds beyond the base, what overlaps an earlier kind is no part."""
    low = text.lower()
    taken: list[tuple[int, int]] = []  # by start, without overlaps
    parts = []
    for k, kind in enumerate(KINDS):
        if kind.hints and not any(h in low for h in kind.hints):
            continue
        found = [(m.start(), k, m.end()) for m in kind.pattern.finditer(text) if kind.valid(m)]
        if k >= len(BASE):
            found = [(s, k, e) for s, k, e in found if not _meets(taken, s, e)]
        if found:
            parts += found
            taken = _merged(taken, found)
    return sorted(parts)


def _meets(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    i = bisect_left(taken, (end,))
    return i > 0 and taken[i - 1][1] > start


def _merged(taken: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted([*taken, *((s, e) for s, _, e in found)]):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _roles(text: str, parts: list[tuple[int, int, int]]) -> list[int]:
    """Roles of the parts; a labelled value that is an access identifier is no secret."""
    inside = [(s, e) for s, k, e in parts if KINDS[k].name == "access"]
    return [IDENTIFIER if KINDS[k].name == "assign" and _meets(inside, s, e) else KINDS[k].role for s, k, e in parts]


def linked(texts: list[str]) -> list[list[tuple[int, int, int, int | None]]]:
    """For each text the spans that stay, as (start, number of the kind, end, start of the nearest complement or None).

    A scope is a block of text between blank lines. The parts of all texts lie on one line, so that the parts of a role
    are one sorted array: each part's window, its scope cut to REACH on both sides, is joined with the complementary
    parts by binary search for its two borders. No pair but the nearest is made.
    """
    found = [proposed(t) for t in texts]
    if not any(found):
        return [[] for _ in texts]
    shift = np.cumsum([0, *[len(t) + REACH + 1 for t in texts]])
    start = np.array([s + o for o, parts in zip(shift.tolist(), found) for s, _, _ in parts])
    role = np.array([r for t, parts in zip(texts, found) for r in _roles(t, parts)])
    blocks = np.array([o + b for o, t, parts in zip(shift.tolist(), texts, found) if parts for b in (0, *(m.end() for m in _BLOCK.finditer(t)))])
    scope = np.searchsorted(blocks, start, side="right") - 1
    after = np.append(blocks[1:], shift[-1])
    low, high = np.maximum(blocks[scope], start - REACH), np.minimum(after[scope] - 1, start + REACH)
    nearest = np.full(len(start), -1)
    for own, wanted in WANTS.items():
        others = np.unique(start[(role & wanted) > 0])
        mine = np.flatnonzero(role == own)
        left = np.searchsorted(others, start[mine], side="right") - 1
        for at in (left, left + 1):
            inside = (at >= 0) & (at < len(others))
            rows, near = mine[inside], others[at[inside]]
            closer = (near >= low[rows]) & (near <= high[rows])
            closer &= (nearest[rows] < 0) | (np.abs(near - start[rows]) < np.abs(nearest[rows] - start[rows]))
            nearest[rows[closer]] = near[closer]
    out, i = [], 0
    for offset, parts in zip(shift.tolist(), found):
        spans = []
        for s, k, e in parts:
            near = None if nearest[i] < 0 else int(nearest[i]) - offset
            if near is not None or not KINDS[k].weak:
                spans.append((s, k, e, near))
            i += 1
        out.append(spans)
    return out


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32()), ("near", pa.int32())]))


def with_spans(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id and `found`, the spans that stay as an array of (s, k, e, near).

    s and e (exclusive) are places in code points of the whole text, k is a number in KINDS, and `near` the start of the
    nearest complementary part, null where there is none. The array goes by start, then kind. Matches of a kind never
    overlap and are found from the left; those that fail their check are dropped and not tried again. Base kinds and
    complete credentials stay by themselves; weak parts (labelled accounts, short or unlabelled secrets, endpoints) stay
    only where a complementary part starts in the same block of text at most REACH characters away.

    A null text counts as empty and has no spans; null and repeated doc_ids pass through. A part is linked within its own
    text, so rows stay where they are: no key gathers, whatever the source or the length. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < len(batch):
                end, size, texts = at, 0, []
                while end < len(batch) and (size < AT_ONCE or end == at):
                    texts.append(batch["text"][end].as_py())
                    size += len(texts[-1])
                    end += 1
                spans = [[{"s": s, "k": k, "e": e, "near": near} for s, k, e, near in x] for x in linked(texts)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, end - at), pa.array(spans, _SPANS)], ["doc_id", "found"])
                at = end

    return text_of(docs).mapInArrow(run, "doc_id long, found array<struct<s: int, k: int, e: int, near: int>>")


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", F.element_at(kinds, m["k"] + 1), m["s"].cast("string"), m["e"].cast("string"))), ",")


def _of_kind(i: int) -> Column:
    return F.size(F.filter("found", lambda m: m["k"] == i)).cast("long")


def secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts of the base kinds, base_sha256, spans. An empty table gives no rows."""
    counts = [_of_kind(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)]
    base = F.filter("found", lambda m: m["k"] < len(BASE))
    return with_spans(docs).select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
