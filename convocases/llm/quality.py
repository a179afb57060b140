"""Quality rules as weak supervision: rules vote or abstain, and expectation maximisation weighs the votes."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import SPACE, text_of, without_space
from convocases.sources.scratch import checkpointed

#: Fixed values of the base measures.
SYMBOLS, WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = "#*$%&|<>", 8, 20, 30

#: (rule, measure, votes good up to, votes bad from, kind); between the two it abstains.
RULES = (
    ("symbols", "n_symbols / n_words", 0.05, 0.3, "strong"),
    ("dup_lines", "n_dup_lines / n_lines", 0.1, 0.5, "strong"),
    ("repeat_words", "n_repeat_words / n_words", 0.05, 0.25, "strong"),
    ("long_words", "word_chars / n_words", 10.0, 25.0, "weak"),
    ("short_words", "n_words / word_chars", 0.4, 0.7, "weak"),
    ("few_words", "100 / n_words", 2.0, 5.0, "weak"),
    ("short_lines", "n_lines / n_words", 0.25, 0.8, "weak"),
)
KINDS = tuple(kind for *_, kind in RULES)

#: Where the rates of the votes good (1), none (0) and bad (-1) start, for good (1) and bad (0) texts, by the kind of
#: rule: good texts (lists, tables, short notes) do break weak rules. The weight, in numbers of all texts, that holds
#: the rates there; and the bounds of the share of good texts.
START = {
    "strong": {1: {1: 0.75, 0: 0.248, -1: 0.002}, 0: {1: 0.6, 0: 0.1, -1: 0.3}},
    "weak": {1: {1: 0.72, 0: 0.25, -1: 0.03}, 0: {1: 0.6, 0: 0.25, -1: 0.15}},
}
HOLD, GOOD_SHARE = 4, (0.5, 0.85)


def measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, all over the whole text.

    Arrays hold one document at most. Repeated windows come from sorting (window hash, position) in documents that have
    any, so long documents cost n log n. Words and windows of a document are compared by 64-bit hashes.
    """
    space = "[" + SPACE + "]+"
    words = F.filter(F.split("text", space), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: without_space(x) != "")
    first = text_of(docs).select(
        "doc_id",
        F.length(without_space(F.col("text"))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
    )
    n = F.size("hashes")
    window = "xxhash64(" + ", ".join(f"hashes[i + {k}]" for k in range(WINDOW)) + ")"
    second = first.select(
        "doc_id", "word_chars", "n_symbols", n.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.expr(f"transform(sequence(0, size(hashes) - {WINDOW}), i -> {window})"))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    third = second.withColumn(
        "ordered",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
               F.array_sort(F.expr("transform(windows, (w, i) -> named_struct('w', w, 'i', i))"))),
    ).drop("windows")
    repeated = third.withColumn("at", F.expr(
        "array_sort(transform(filter(ordered, (x, k) -> (k > 0 and ordered[k - 1].w = x.w)"
        " or (k < size(ordered) - 1 and ordered[k + 1].w = x.w)), x -> x.i))"
    )).drop("ordered")
    covered = F.expr(
        f"aggregate(transform(at, (p, k) -> if(k = size(at) - 1, {WINDOW}, least({WINDOW}, at[k + 1] - p))), 0L, (s, x) -> s + x)"
    )
    return repeated.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("at")


def _vote(measure: str, good: float, bad: float) -> Column:
    value = F.expr(f"cast(try_divide({measure.split(' / ')[0]}, {measure.split(' / ')[1]}) as double)")
    return F.when(value <= good, 1).when(value >= bad, -1).otherwise(0)


def fit_votes(
    patterns: list[tuple[tuple[int, ...], int]], kinds: tuple[str, ...] = KINDS, rounds: int = 50, prior: float = 0.85,
) -> tuple[float, list[tuple[float, float]]]:
    """Expectation maximisation over (votes, count): share of good texts, and per rule the log weights of its votes.

    `patterns` has a row for each combination of votes that occurs, at most 3 ** len(RULES) whatever the corpus. A rule
    has a rate for each vote among good and among bad texts. Bad texts are bad in one way as a rule, so most rules find
    nothing wrong with them either, and agreement alone can't tell a rule that alone finds its kind of junk from one that
    errs: what a rule's kind says of it decides there. So the rates start from the kind's and are held to them with the
    weight of HOLD times as many texts as there are, which gives the same verdicts at every size. A lone bad vote of a
    strong rule rejects a text, one of a weak rule is outvoted by the others, two of them are not.
    """
    rules = len(patterns[0][0]) if patterns else 0
    start = [START[kind] for kind in kinds[:rules]]
    rate = {c: [dict(start[r][c]) for r in range(rules)] for c in (0, 1)}
    total = sum(k for _, k in patterns) or 1
    good = prior
    for _ in range(rounds):
        mass = {c: [dict.fromkeys((1, 0, -1), 0.0) for _ in range(rules)] for c in (0, 1)}
        share = 0.0
        for votes, count in patterns:
            odds = math.log(good / (1 - good)) + sum(math.log(rate[1][r][v] / rate[0][r][v]) for r, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            share += p * count
            for r, v in enumerate(votes):
                mass[1][r][v] += p * count
                mass[0][r][v] += (1 - p) * count
        good = min(GOOD_SHARE[1], max(GOOD_SHARE[0], share / total))
        for c in (0, 1):
            for r in range(rules):
                whole = sum(mass[c][r].values())
                rate[c][r] = {v: (mass[c][r][v] + HOLD * total * start[r][c][v]) / (whole + HOLD * total) for v in (1, 0, -1)}
    weights = [
        (max(0.0, math.log(rate[1][r][1] / rate[0][r][1])), min(0.0, math.log(rate[1][r][-1] / rate[0][r][-1])))
        for r in range(rules)
    ]
    return math.log(good / (1 - good)), weights


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: the measures, base_failed, p_good, kept.

    A rule votes good, bad or abstains; an abstention has no weight. Accuracies are estimated from the counts of vote
    combinations over all documents, p_good is the posterior probability, and a text stays if its p_good is at least
    0.5 (a tie stays) and it doesn't fail the base limits. Rows that repeat count, and are judged, each. The measures are written once to the shared folder, as both the fit and the
    verdicts read them. A null or empty text has no words, so it fails the base; an empty table gives no rows.
    """
    measured = checkpointed(measures(docs))
    votes = [_vote(m, good, bad).alias(f"_{name}") for name, m, good, bad, _ in RULES]
    names = [f"_{name}" for name, *_ in RULES]
    voted = measured.select("*", *votes)
    counted = voted.groupBy(*names).count().collect()  # at most 3 ** len(RULES) rows
    bias, weights = fit_votes(sorted((tuple(r[:-1]), r[-1]) for r in counted))
    odds = F.lit(bias)
    for name, (up, down) in zip(names, weights):
        odds = odds + F.when(F.col(name) == 1, up).when(F.col(name) == -1, down).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    p = 1 / (1 + F.exp(-odds))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (p >= 0.5)).alias("kept"), "n_lines", p.alias("p_good"),
    )
