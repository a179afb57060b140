"""Toxicity: a weighted grammar of insults, threats, targets, negation and reported speech over clauses."""

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import text_of
from convocases.sources.scratch import checkpointed

#: Labelled rows that a fit reads at most. What it keeps of their words is bounded by them alone.
SAMPLE = 20_000

#: A word or beginning of words counts if so many sampled documents have it; lengths of beginnings.
SUPPORT, LENGTHS = 4, range(3, 10)

#: Words whose log odds are below this are no insults.
LEAST_ODDS = 2.0

#: Predicted toxic from this score on.
THRESHOLD = 0.7

#: Words of the other classes.
THREATS = "kill hurt destroy stab shoot beat burn hang strangle punch murder".split()
THREAT_FORMS = (
    "shot beaten hung burnt töten töte tötest tötet tötete getötet umbringen umbringe umbringst umbringt umgebracht"
    " tuer tue tues tuez tuerai tuera tué matar mato matas mata mataré matará matado matando").split()
TARGETS = frozenset(
    "you your yours yourself u he him his she her they them their those people du dich dir ihr euch tu te toi vous tú usted ustedes".split())
NEGATIONS = frozenset("not no never none neither nor isn aren don doesn didn won cannot nicht kein keine nie pas jamais non nunca jamás".split())
REPORTS = frozenset("said says say wrote writes quoted quotes claimed claims called reported told sagte schrieb dit écrit dijo escribió".split())



def _inflected(verb: str) -> set[str]:
    """An English verb with its regular endings: a silent e goes, a short vowel doubles the consonant behind it."""
    stem = verb.removesuffix("e")
    if re.fullmatch("[^aeiou]+[aeiou][bgpt]", verb):
        stem += verb[-1]
    return {verb, verb + ("es" if verb.endswith(("sh", "ch", "s")) else "s"), stem + "ed", stem + "ing"}


_THREATS = frozenset(THREAT_FORMS).union(*map(_inflected, THREATS))
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[^.!?;:\n]+")
_KEPT_WORDS = 500_000


@dataclass(frozen=True)
class Transducer:
    """States, and for a state and a symbol: the next state, the symbol that goes on, and a weight. Others pass unchanged."""

    start: object
    step: Callable[[object, str], tuple[object, str, float]]

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: what this one writes, the other reads; weights add up."""
        seen: dict[tuple, tuple] = {}

        def step(state, symbol):
            if (state, symbol) not in seen:
                one, middle, a = self.step(state[0], symbol)
                two, out, b = other.step(state[1], middle)
                seen[state, symbol] = (one, two), out, a + b
            return seen[state, symbol]

        return Transducer((self.start, other.start), step)


def _negation(scope: int = 3) -> Transducer:
    """Within `scope` words of a negation an insult or threat is denied: I becomes i, T becomes t."""
    def step(left, symbol):
        if symbol == "N":
            return scope, "O", 0.0
        return max(0, left - 1), symbol.lower() if left and symbol in "IT" else symbol, 0.0
    return Transducer(0, step)


def _report() -> Transducer:
    """After a word of speech an insult or threat of the clause is someone else's, and counts as denied."""
    def step(heard, symbol):
        if symbol == "R":
            return 1, "O", 0.0
        return heard, symbol.lower() if heard and symbol in "IT" else symbol, 0.0
    return Transducer(0, step)


def _target(bonus: float = 0.5, threat: float = 2.0) -> Transducer:
    """An insult and its target, in either order, weigh more together; a threat counts with a target, before or behind it."""
    def step(state, symbol):
        target, waiting = state
        if symbol == "Y":
            return (True, ""), "O", {"": 0.0, "I": bonus, "T": threat}[waiting]
        if symbol == "I":
            return (target, "" if target else "I"), symbol, bonus if target else 0.0
        if symbol == "T":
            return (target, "" if target else "T"), "O", threat if target else 0.0
        return state, symbol, 0.0
    return Transducer((False, ""), step)


def _value(denied: float = 0.25) -> Transducer:
    """What is left of the insults: one counts whole, a denied one by a part."""
    worth = {"I": 1.0, "i": denied}

    def step(state, symbol):
        return state, symbol, worth.get(symbol, 0.0)
    return Transducer(0, step)


GRAMMAR = _negation().then(_report()).then(_target()).then(_value())


class Lexicon:
    """Log odds of words, from the sampled documents with a stem (n) and the toxic ones among them (t).

    A word is judged by its own counts if enough documents had it, else by those of its longest common beginning.
    """

    def __init__(self, counts: dict[str, tuple[int, int]], base: float):
        self.counts, self.base, self.known = counts, base, {}

    def odds(self, word: str, label: int | None = None) -> float:
        """`label` takes out a document of that label that was counted, so it isn't judged by itself."""
        mine, toxic = (0, 0) if label is None else (1, label)
        for stem in (word + "$", *(word[:n] for n in reversed(LENGTHS) if n <= len(word))):
            found = self.counts.get(stem)
            if found and found[0] - mine >= SUPPORT:
                n, t = found[0] - mine, found[1] - toxic
                return float(np.log((t + 0.5) / (n - t + 0.5))) - self.base
        return 0.0

    def symbol(self, word: str, label: int | None = None) -> tuple[str, float] | None:
        """Class of a word and its weight; None for words of no class."""
        key = word, label
        if key in self.known:
            return self.known[key]
        found = None
        if word in NEGATIONS:
            found = "N", 0.0
        elif word in REPORTS:
            found = "R", 0.0
        elif word in TARGETS:
            found = "Y", 0.0
        elif word in _THREATS:
            found = "T", 1.0
        elif (odds := self.odds(word, label)) >= LEAST_ODDS:
            found = "I", odds
        if len(self.known) < _KEPT_WORDS:
            self.known[key] = found
        return found


def _weights(symbols: list[str]) -> list[float]:
    """The grammar's weight of each place of a clause; what a target adds goes to the insult or threat that waits for it."""
    state, out, waiting = GRAMMAR.start, [0.0] * len(symbols), 0
    for at, symbol in enumerate(symbols):
        state, written, value = GRAMMAR.step(state, symbol)
        if symbol in "IT" and not written.islower():
            waiting = at
        if value:
            out[waiting if symbol == "Y" else at] += value
    return out


def _score(symbols: list[str], places: dict[int, float]) -> float:
    """The grammar's weight along a clause, times the mean odds, if of its insults and threats only those at `places` (with odds) count."""
    if not places:
        return 0.0
    total = sum(_weights([s if s not in "IT" or at in places else "O" for at, s in enumerate(symbols)]))
    return total * sum(places.values()) / len(places)


def _both_scores(text: str, lexicon: Lexicon, label: int | None = None) -> tuple[list[float], list[float]]:
    """The scores of clauses, each on its own, and where a word counts once in the text; only those above 0.

    A word that repeats counts at the place where the grammar gives it the largest weight, the first of them: in the
    clause where the clause is scored on its own, else in the text.
    """
    text = text.lower()
    classes = {w: s for w in set(_WORD.findall(text)) if (s := lexicon.symbol(w, label))}
    if not any(s[1] for s in classes.values()):
        return [], []
    own, found = [], []
    best: dict[str, tuple[float, int, int]] = {}
    for clause in _CLAUSE.findall(text):
        words = _WORD.findall(clause)
        marked = {at: w for at, w in enumerate(words) if w in classes and classes[w][1]}
        if not marked:
            continue
        symbols = [classes[w][0] if w in classes else "O" for w in words]
        weights = _weights(symbols)
        here: dict[str, int] = {}
        for at, word in marked.items():
            if word not in here or weights[at] > weights[here[word]]:
                here[word] = at
        places = {at: classes[w][1] for at, w in marked.items() if here[w] == at}
        own.append(_score(symbols, places))
        for word, at in here.items():
            if word not in best or weights[at] > best[word][0]:
                best[word] = weights[at], len(found), at
        found.append((symbols, marked, places))
    once = []
    for i, (symbols, marked, places) in enumerate(found):
        left = {at: odds for at, odds in places.items() if best[marked[at]][1] == i}
        once.append(own[i] if len(left) == len(places) else _score(symbols, left))
    return [x for x in own if x > 0], [x for x in once if x > 0]


def clause_scores(text: str, lexicon: Lexicon, label: int | None = None) -> list[float]:
    """The weight of each clause that has an insult or threat: the grammar's weight along it, times its words' mean odds.

    Every clause is judged, and an insult or threat that the text repeats counts once, where it weighs most.
    """
    return _both_scores(text, lexicon, label)[1]


def document_features(text: str, lexicon: Lexicon, label: int | None = None) -> tuple[float, float]:
    """The best clause on its own, and all clauses, with each word once, for each hundred words or so; both 0 where nothing matched."""
    own, once = _both_scores(text, lexicon, label)
    return max(own, default=0.0), sum(once) / (1 + len(text) / 600)


def features_of_words(text: str) -> set[str]:
    """The document's words, marked with $, and their beginnings."""
    words = set(_WORD.findall(text.lower()))
    return {w + "$" for w in words} | {w[:n] for w in words for n in LENGTHS if n <= len(w)}


@dataclass(frozen=True)
class Model:
    counts: dict[str, tuple[int, int]]
    base: float
    weights: tuple[float, float, float]

    def scorer(self) -> Callable[[str | None], float]:
        lexicon = Lexicon(self.counts, self.base)

        def score(text: str | None) -> float:
            x = sum(w * f for w, f in zip(self.weights, (1.0, *document_features(text or "", lexicon))))
            return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))

        return score


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps with a ridge; the weights of the features, though not the bias, stay at 0 or above."""
    w = np.zeros(x.shape[1])
    keep = np.ones(x.shape[1], bool)
    for _ in range(x.shape[1]):
        w = np.where(keep, w, 0)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
            step = np.linalg.solve(hessian[np.ix_(keep, keep)], (x.T @ (y - p) - ridge * w)[keep])
            w[keep] += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if not (w[1:] < 0).any():
            break
        keep[1:] &= w[1:] >= 0
    return np.where(keep, w, 0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Odds of words and beginnings, and the weights of a document's clauses, from labelled rows that are not held out.

    At most `sample` labelled rows, the first by a hash, are read and written to the shared folder. Both the odds and
    the weights come from all of them; for the weights, a document is left out of the counts it is judged by. Kept are
    all stems of high odds, and all longer ones that take words back from them. Without labels of both kinds the score
    is the smoothed share of toxic rows.
    """
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marked = marked.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    chosen = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = checkpointed(text_of(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic"))  # at most `sample` rows

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                own = features_of_words(text)
                every.update(own)
                if label:
                    toxic.update(own)
        rows = [(stem, n, toxic[stem]) for stem, n in every.items()]
        for at in range(0, len(rows), 10_000):
            yield pd.DataFrame(rows[at:at + 10_000], columns=["stem", "n", "t"])

    n, t = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = float(np.log((t + 0.5) / (n - t + 0.5)))
    counts = texts.mapInPandas(count, "stem string, n long, t long").groupBy("stem").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    odds = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - F.lit(base)
    common = checkpointed(counts.where(F.col("n") >= SUPPORT).withColumn("odds", odds))
    strong = common.where(F.col("odds") >= LEAST_ODDS)
    begins = strong.where(~F.col("stem").endswith("$")).select(F.col("stem").alias("begin"))
    longer = common.where(F.col("odds") < LEAST_ODDS).withColumn(
        "begin", F.explode(F.array(*[F.substring("stem", 1, n) for n in LENGTHS]))).where("begin <> stem")
    weak = longer.join(begins, "begin").select("stem", "n", "t").distinct()
    known = {r.stem: (r.n, r.t) for r in strong.select("stem", "n", "t").unionByName(weak).collect()}  # words of the sample only

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(known, base)
        for batch in batches:
            rows = [document_features(x, lexicon, y) for x, y in zip(batch["text"], batch["toxic"])]
            yield pd.DataFrame(rows, columns=["a", "b"]).assign(toxic=batch["toxic"].to_numpy())

    seen = texts.mapInPandas(measure, "a double, b double, toxic int").collect()  # at most `sample` rows of three numbers
    data = np.array([tuple(r) for r in seen], float).reshape(-1, 3)
    if len(set(data[:, 2])) < 2:
        return Model(known, base, (base, 0.0, 0.0))
    data = data[np.lexsort(data.T)]
    return Model(known, base, tuple(map(float, _logistic(np.column_stack([np.ones(len(data)), data[:, :2]]), data[:, 2]))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row. A null or empty text has the score of a text without any match."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score_of = model.scorer()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [score_of(t) for t in batch["text"]]})

    return text_of(docs).mapInPandas(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (1 from `threshold` on).

    Only the text is scored. Rows without a doc_id are not held out. Empty tables are fine: without documents there are
    no rows, without labels all scores are alike.
    """
    model = fit(docs, labels, sample)
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` whose score is below `threshold`, with its columns."""
    model = fit(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([score_of(t.as_py()) < threshold for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
