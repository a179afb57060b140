"""The operators' contracts in plain Python, one document after another."""

import hashlib
import re
import zlib
from collections import Counter

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(x: str) -> str:
    return re.sub("[^0-9]", "", x)


def flat(pattern: str):
    """Possessive on the repeat, so that long runs don't go deep; nothing follows it."""
    return re.compile(pattern)


BASE = [
    ("email", flat(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda x: True),
    ("ip", flat(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda x: all(int(p) <= 255 for p in x.split("."))),
    ("card", flat(r"[0-9]([\x20-]?[0-9])+"), lambda x: 12 <= len(only_digits(x)) <= 19 and luhn(only_digits(x))),
    ("phone", flat(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda x: 9 <= len(only_digits(x)) <= 15),
]


def personal_data(text: str | None) -> tuple:
    text = text or ""
    spans, counts = [], []
    for k, (name, pattern, valid) in enumerate(BASE):
        found = [m for m in pattern.finditer(text) if valid(m[0])]
        counts.append(len(found))
        spans += [(m.start(), k, m.end()) for m in found]
    joined = ",".join(f"{BASE[k][0]}:{s}:{e}" for s, k, e in sorted(spans))
    return *counts, hashlib.sha256(joined.encode()).hexdigest()


def measures(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def quality(rows: list[tuple[int, str | None]], rules, starts, hold: float, bounds: tuple[float, float]) -> list[tuple]:
    """(doc_id, kept, p_good): votes text by text, expectation maximisation over all texts one by one."""
    votes, failed = [], []
    for _, text in rows:
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base = measures(text)
        n_lines = sum(1 for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r"))
        known = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
                 "n_repeat_words": n_repeat_words, "n_lines": n_lines, "100": 100}
        own = []
        for _, measure, good, bad, _ in rules:
            a, b = (known[x] for x in measure.split(" / "))
            own.append(0 if b == 0 else 1 if a / b <= good else -1 if a / b >= bad else 0)
        votes.append(own)
        failed.append(base)
    rates = [{c: dict(starts[kind][c]) for c in (0, 1)} for *_, kind in rules]
    share = bounds[1]
    for _ in range(50):
        p = []
        for own in votes:
            a, b = share, 1 - share
            for rate, v in zip(rates, own):
                a, b = a * rate[1][v], b * rate[0][v]
            p.append(a / (a + b))
        share = min(bounds[1], max(bounds[0], sum(p) / len(p)))
        for r, (*_, kind) in enumerate(rules):
            for c in (0, 1):
                part = [x if c else 1 - x for x in p]
                whole = sum(part) + hold * len(rows)
                rates[r][c] = {v: (sum(x for x, own in zip(part, votes) if own[r] == v) + hold * len(rows) * starts[kind][c][v]) / whole
                               for v in (1, 0, -1)}
    out = []
    for (doc_id, _), own, base in zip(rows, votes, failed):
        odds = share / (1 - share)
        for rate, v in zip(rates, own):
            odds *= max(1, rate[1][1] / rate[0][1]) if v == 1 else min(1, rate[1][-1] / rate[0][-1]) if v == -1 else 1
        out.append((doc_id, not base and odds >= 1, odds / (1 + odds)))
    return out


def exact(rows: list[tuple[int, str | None]]) -> list[tuple]:
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault("".join(c for c in text if c not in SPACE), []).append((-len(text), doc_id))
    out = []
    for doc_id, text in rows:
        content = "".join(c for c in text or "" if c not in SPACE)
        keep = min(groups[content])[1]
        out.append((doc_id, keep, len(groups[content]), doc_id == keep, hashlib.sha256(content.encode()).hexdigest()))
    return out


def shingles(text: str | None, size: int = 4) -> set:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def near(rows: list[tuple[int, str | None]], size: int = 4) -> dict[int, tuple]:
    """doc_id: n_shingles, component_id, kept"""
    sets = {doc_id: shingles(text, size) for doc_id, text in rows}
    at = {doc_id: doc_id for doc_id in sets}

    def top(x):
        while at[x] != x:
            x = at[x]
        return x

    where: dict = {}
    for doc_id in sets:
        for s in sets[doc_id]:
            where.setdefault(s, []).append(doc_id)
    tried = set()
    for ids in where.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((top(a), top(b)))
                        at[y] = x
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


def repeated_bytes(rows: list[tuple[int, str | None]], size: int = 200) -> dict[int, tuple]:
    """doc_id: n_bytes, n_removed, n_spans, kept_sha256"""
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    often = Counter(t[i:i + size] for _, t in texts for i in range(len(t) - size + 1))
    out = {}
    for doc_id, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if often[t[i:i + size]] > 1:
                gone[i:i + size] = b"\x01" * size
        runs = len(re.findall(b"\x01+", bytes(gone)))
        left = bytes(c for c, g in zip(t, gone) if not g)
        out[doc_id] = (len(t), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


SECRETS = [
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
     lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def secrets(text: str | None) -> tuple:
    """n_assign, n_access, n_hex, base_sha256, base spans"""
    spans, counts = [], []
    for k, (name, pattern, valid) in enumerate(SECRETS):
        found = [m for m in pattern.finditer(text or "") if valid(m)]
        counts.append(len(found))
        spans += [(m.start(), k, m.end()) for m in found]
    joined = [f"{SECRETS[k][0]}:{s}:{e}" for s, k, e in sorted(spans)]
    return *counts, hashlib.sha256(",".join(joined).encode()).hexdigest(), joined


def linked(text: str, parts: list[tuple[int, int, int]], roles: list[int], weak: list[bool], wants: dict[int, int], reach: int) -> list:
    """Spans that stay with the start of their nearest complement, every part held against every other."""
    borders = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    block = [sum(b <= s for b in borders) for s, _, _ in parts]
    out = []
    for i, (s, k, e) in enumerate(parts):
        near = sorted((abs(t - s), t) for j, (t, _, _) in enumerate(parts)
                      if roles[j] & wants.get(roles[i], 0) and block[j] == block[i] and abs(t - s) <= reach)
        if near or not weak[i]:
            out.append((s, k, e, near[0][1] if near else None))
    return out


def fill_in_middle(doc_id: int | None, text: str | None) -> tuple:
    """n, form, prefix_chars, middle_chars, output"""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def hashed(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return hashed("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def _levels(nodes: list[str], fanout: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hashed(levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def _steps(levels: list[list[str]], i: int, fanout: int) -> list[tuple[list[str], list[str]]]:
    out = []
    for level in levels[:-1]:
        run = i // fanout * fanout
        out.append((level[run:i], level[i + 1:run + fanout]))
        i //= fanout
    return out


def manifest(rows: list[tuple], fanout: int = 3) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, source, lang, n_chars, text)"""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = _levels([leaf(r) for r in groups[source]], fanout)
    top = _levels([trees[s][-1][0] for s in order], fanout) if order else []
    out = []
    for g, source in enumerate(order):
        for i, row in enumerate(groups[source]):
            steps = _steps(trees[source], i, fanout) + _steps(top, g, fanout)
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            x = leaf((*row[:4], text))
            for left, right in steps:
                x = hashed([*left, x, *right])
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[source][-1][0], root, hashed(h for step in steps for side in step for h in side), x, x == root))
    return out
