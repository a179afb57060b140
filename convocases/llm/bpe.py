"""Byte-pair encoding and decoding: many words at once in flat numpy arrays."""

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from convocases.llm.common import text_of

#: Fixed value: how the vocabulary cuts ASCII text in lower case into words. Other text goes through the tokenizer file's own rules.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0da-z0-9]+")
_SPACE = re.compile(r"\s")  # all that the file's rules take for white space
_NEVER = np.int32(2**31 - 1)

#: Most chunks of text whose ids a worker remembers, the longest it remembers, and the text it works on at once.
REMEMBERED, LONGEST, AT_ONCE = 500_000, 64, 2_000_000


class BytePairs:
    """Encoder and decoder for a tokenizer file with byte-level words that end in a suffix.

    A chunk is text between spaces and line feeds. No rule of the file looks across those, so the ids of a text are
    those of its chunks, one after another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = _spec(path)
        self.rules = Tokenizer.from_file(path)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.size = np.int64(size)
        chars = _byte_chars()
        self.char_byte = {ord(c): b for c, b in chars.items()}
        self.inner, self.final = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for c, b in chars.items():
            self.inner[b], self.final[b] = vocab[c], vocab[c + self.suffix]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        a, b, made = (np.array(x, np.int64) for x in zip(*pairs))
        keys = a * self.size + b
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order].astype(np.int32)
        # A round may merge all places of a word's best pair if no merge of the new symbol comes before the pair's own.
        first = np.full(size, _NEVER, np.int64)
        np.minimum.at(first, a, np.arange(len(a)))
        np.minimum.at(first, b, np.arange(len(b)))
        self.whole_rounds = bool((first[made] > np.arange(len(made))).all())
        self.known: dict[str, bytes] = {}

    def _search(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the sorted pair keys, and rank or _NEVER, of each pair of symbols."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return at, np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def merge(self, flat: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each. `flat`: the words' bytes, none empty.

        In a round every word merges its pair of lowest rank, and only pairs beside a new symbol are searched again;
        words without a pair leave the arrays.
        """
        count = len(sizes)
        flat = np.frombuffer(flat, np.uint8)
        ends = np.cumsum(sizes) - 1
        symbols = self.inner[flat]
        symbols[ends] = self.final[flat[ends]]
        word = np.repeat(np.arange(count), sizes)
        at, rank = self._search(symbols, np.append(symbols[1:], 0))
        rank[ends] = _NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
            over = best == _NEVER
            if over.any():
                done.append((word[over], symbols[over]))
            place = np.flatnonzero((rank == best) & ~over)
            if not len(place):
                break
            if self.whole_rounds:  # of places that overlap, as in aaa, every second one
                run = np.maximum.accumulate(np.where(np.append(True, np.diff(place) > 1), np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - run) % 2 == 0]
            else:  # the leftmost of each word
                place = place[np.append(True, np.diff(word[place]) > 0)]
            symbols[place] = self.made[at[place]]
            keep = ~over
            keep[place + 1] = False
            symbols, word, rank, at, merged = symbols[keep], word[keep], rank[keep], at[keep], (np.cumsum(keep) - 1)[place]
            near = np.concatenate([merged[merged > 0] - 1, merged])
            rank[near] = _NEVER
            near = near[near < len(word) - 1]
            near = near[word[near] == word[near + 1]]
            at[near], rank[near] = self._search(symbols[near], symbols[near + 1])
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        of = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        return ids[np.argsort(of, kind="stable")], np.bincount(of, minlength=count)

    def _words(self, chunks: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The words of chunks without special tokens, as bytes, and the chunk of each."""
        joined = " ".join(chunks)
        if joined.isascii():
            cut = re.findall(_ASCII_WORDS.pattern + "| ", joined.lower())
            of = np.fromiter((w == " " for w in cut), np.int64, len(cut)).cumsum()
            word = np.fromiter((w != " " for w in cut), bool, len(cut))
            return [w.encode() for w in cut if w != " "], of[word]
        if len(chunks) > 1 and _SPACE.search("".join(chunks)):  # which the rules would fold with the borders
            each = [self._words([c])[0] for c in chunks]
            return [w for words in each for w in words], np.repeat(np.arange(len(chunks)), list(map(len, each)))
        plain = self.rules.normalizer.normalize_str(joined)
        borders = np.cumsum([len(x) + 1 for x in plain.split(" ")]) if len(chunks) > 1 else np.array([len(plain) + 1])
        cut = self.rules.pre_tokenizer.pre_tokenize_str(plain)
        of = np.searchsorted(borders, np.fromiter((at for _, (at, _) in cut), np.int64, len(cut)), side="right")
        return [w.translate(self.char_byte).encode("latin-1") for w, _ in cut], of

    def learn(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """The ids of each chunk, as little-endian 32-bit integers."""
        plain = {"ascii": [], "other": [], "spaced": []}
        found: dict[str, bytes] = {}
        for chunk in chunks:
            if "<|" in chunk and self.special_cut.search(chunk):
                found[chunk] = b"".join(
                    np.int32(self.special[x]).tobytes() if x in self.special else self.learn([x])[x]
                    for x in self.special_cut.split(chunk)
                )
            else:
                plain["ascii" if chunk.isascii() else "spaced" if _SPACE.search(chunk) else "other"].append(chunk)
        for own in filter(None, plain.values()):
            words, of = self._words(own)
            ids, counts = self.merge(b"".join(words), np.fromiter(map(len, words), np.int64, len(words)))
            ends = 4 * np.cumsum(np.bincount(of, counts, len(own)).astype(np.int64))
            raw = ids.astype("<u4").tobytes()
            found.update(zip(own, map(raw.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))))
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian 32-bit integers. Chunks met before are looked up."""
        cut: list[list[str]] = []
        size = 0
        for text in texts:
            cut.append(text.replace("\n", " ").split(" "))
            size += len(text)
            if size > AT_ONCE:
                yield from self._encode(cut)
                cut, size = [], 0
        yield from self._encode(cut)

    def _encode(self, cut: list[list[str]]) -> list[bytes]:
        found = self.learn(set().union(*cut).difference(self.known))
        self.known.update(found)
        out = [b"".join(map(self.known.__getitem__, chunks)) for chunks in cut]
        full = len(self.known) > REMEMBERED
        for chunk in [c for c in found if full or len(c) > LONGEST]:
            del self.known[chunk]
        return out


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Tokens:
    """Decoder for a tokenizer file without a decoder of its own."""

    def __init__(self, path: str):
        spec = _spec(path)
        every = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.tokens = np.empty(max(every.values()) + 1, dtype=object)
        for token, i in every.items():
            self.tokens[i] = token.encode()

    def decode(self, ids: bytes) -> bytes:
        """The tokens of the ids in UTF-8, special ones too, with a space between them."""
        return b" ".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


def _byte_chars() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def load(path: str) -> BytePairs:
    """One encoder for each worker process and file."""
    return BytePairs(path)


@lru_cache(maxsize=4)
def load_tokens(path: str) -> Tokens:
    return Tokens(path)


def slices(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Smaller batches, so that a worker never holds the results of a large one."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at:at + rows]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (binary, little-endian 32-bit). `path`: tokenizer file, on every executor.

    The ids are those of the file's tokenizer without special tokens added; special tokens that stand in a text get
    their ids. A null or empty text has no ids. Work stays in one row, so there is no shuffle; a worker holds a few MB
    of text and a bounded number of chunks.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = load(path)
        for batch in slices(batches):
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "ids": list(pairs.encode(batch["text"].tolist()))})

    return text_of(docs).mapInPandas(run, "doc_id long, ids binary")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` (doc_id, ids as `encode` gives them) with decoded: the tokens' text. Null ids count as none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens_of = load_tokens(path)
        for batch in slices(batches, 200):
            text = [tokens_of.decode(ids or b"").decode() for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "ids": batch["ids"].array, "decoded": text})

    return tokens.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids binary, decoded string")
