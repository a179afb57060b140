"""Classification: reply checks, taxonomy lookup, labels on messages, and a model-free rule."""

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from convocases.functions import text
from convocases.operators.blocks import join_spread
from convocases.operators.cases import HEAD_MESSAGES, assigned_only, case_head
from convocases.operators.replies import (
    CLASSIFICATION_KEYS, extract_json_classification, field, first_good_reply, has_keys, is_object, kind,
)
from convocases.operators.taxonomy import leaf_index, leaf_words, small


def taxonomy_lookup(labels: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """`label_reason`: bad_primary or bad_secondary where (primary, secondary) is not in the taxonomy."""
    primaries = small(taxonomy.select("primary").distinct().withColumn("_primary_ok", F.lit(True)))
    leaves = small(taxonomy.select("primary", "secondary").distinct().withColumn("_leaf_ok", F.lit(True)))
    joined = labels.join(primaries, ["primary"], "left").join(leaves, ["primary", "secondary"], "left")
    reason = F.when(F.col("_primary_ok").isNull(), "bad_primary").when(F.col("_leaf_ok").isNull(), "bad_secondary")
    return joined.withColumn("label_reason", reason).drop("_primary_ok", "_leaf_ok")


def validate_classification(replies: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row per reply with `category`, `confidence`, `reasoning`; `reason` says why there is none."""
    read = replies.withColumns(extract_json_classification(F.col("content")))
    body = F.try_parse_json("json")
    primary, secondary = field(body, "primary_category"), field(body, "secondary_category")
    raw = read.withColumns({
        "_body_reason": F.when(F.col("json").isNull(), "no_json")
        .when(~is_object(F.col("json")), "bad_json")
        .when(~has_keys(body, CLASSIFICATION_KEYS), "missing_key"),
        "primary": F.when(kind(primary) == "STRING", field(body, "primary_category", "string")),
        "secondary": F.when(kind(secondary) == "STRING", field(body, "secondary_category", "string")),
        "_raw_confidence": field(body, "confidence", "double"),
        "reasoning": field(body, "reasoning", "string"),
    }).drop("json", "branch")
    checked = taxonomy_lookup(raw, taxonomy)
    reason = F.coalesce(
        F.col("_body_reason"), F.col("label_reason"), F.when(F.col("_raw_confidence").isNull(), "bad_confidence")
    )
    checked = checked.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return checked.withColumns({
        "category": F.when(good, text.combine_category(F.col("primary"), F.col("secondary"))),
        "confidence": F.when(good, text.clamp_confidence(F.col("_raw_confidence"))),
    }).drop("_body_reason", "label_reason", "_raw_confidence")


def classifications_of_replies(
    requests: DataFrame, replies: DataFrame, taxonomy: DataFrame, classified_at: Column | None = None
) -> DataFrame:
    """Accepted classifications by case number."""
    at = F.current_timestamp() if classified_at is None else classified_at
    answers = first_good_reply(replies.select("request_id", "content", "error")).where(F.col("error").isNull())
    checked = validate_classification(answers, taxonomy).where(F.col("reason").isNull())
    return requests.select("request_id", "case_number").join(checked, ["request_id"]).select(
        "case_number", "category", "confidence", "reasoning", at.alias("classified_at")
    )


def classifications_dedup(classified: DataFrame) -> DataFrame:
    """One classification per case from labelled messages; the last row by time and ingest order wins."""
    rows = assigned_only(assigned_only(classified), "category")
    label = F.struct("category", "classification_confidence", "classification_reasoning", "classified_at")
    place = F.struct("created_time", "ingest_seq", "message_id")
    return rows.groupBy("case_number").agg(F.max_by(label, place).alias("_l")).select(
        "case_number", "_l.category", F.col("_l.classification_confidence").alias("confidence"),
        F.col("_l.classification_reasoning").alias("reasoning"), "_l.classified_at",
    )


def assign_categories(messages: DataFrame, classifications: DataFrame) -> DataFrame:
    """Category columns on every row of a classified case; all others get defaults.

    One case may hold a large share of the rows, so hot cases are dealt into shares.
    """
    labels = classifications.select(
        "case_number", "category", F.col("confidence").alias("classification_confidence"),
        F.col("reasoning").alias("classification_reasoning"), "classified_at",
    )
    left = messages.drop("category", "classification_confidence", "classification_reasoning", "classified_at")
    spread = [c for c in ("ingest_seq", "message_id", "created_time") if c in left.columns]
    joined = join_spread(left, labels, ["case_number"], spread=spread)
    return joined.withColumns({
        "category": F.coalesce("category", F.lit("")),
        "classification_confidence": F.coalesce("classification_confidence", F.lit(0.0)),
        "classification_reasoning": F.coalesce("classification_reasoning", F.lit("")),
    })


def case_excerpt_lines(labelled: DataFrame, n: int = HEAD_MESSAGES) -> DataFrame:
    """First messages of each case as text lines, with the number left out."""
    head = case_head(labelled, n)
    time = F.date_format("created_time", "yyyy-MM-dd HH:mm:ss")
    line = F.format_string(
        "**Message %d** [%s] (%s) (%s): %s",
        F.col("case_pos"), F.col("sender_type"), F.col("sender_id"), time, F.trim("message"),
    )
    return head.withColumn("line", line)


def format_case_excerpt(labelled: DataFrame, n: int = HEAD_MESSAGES) -> DataFrame:
    """`case_number, excerpt`: at most `n` lines per case and a note on the rest."""
    per_case = case_excerpt_lines(labelled, n).groupBy("case_number").agg(
        F.sort_array(F.collect_list(F.struct("case_pos", "line"))).alias("_lines"), F.max("remaining").alias("remaining")
    )
    lines = F.transform("_lines", lambda x: x["line"])
    more = F.when(F.col("remaining") > 0, F.format_string("... and %d more messages", F.col("remaining")))
    return per_case.select("case_number", F.concat_ws("\n\n", lines, more).alias("excerpt"))


def numbered_leaves(taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`_leaf, primary, secondary, n_words` by name from 0, and `_known, word, _leaves`: words from 0 with the leaves that have them."""
    words = leaf_words(taxonomy)
    names = words.select("primary", "secondary", "n_words").distinct()
    leaves = names.withColumn("_leaf", F.row_number().over(Window.orderBy("primary", "secondary")) - 1)
    held = words.drop("n_words").join(leaves, ["primary", "secondary"]).groupBy("word").agg(F.collect_list("_leaf").alias("_leaves"))
    return leaves, held.withColumn("_known", F.row_number().over(Window.orderBy("word")) - 1)


def constant(rows: DataFrame, column: str, kind: str) -> Column:
    """The values of a small ordered table as one array, by their place."""
    return F.from_json(F.lit(json.dumps([r[0] for r in rows.select(column).collect()])), kind)


def classify_by_rules(labelled: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Leaf whose words are best covered by the words of the case; `Other_Other` with 0.0 if none is.

    Words meet the vocabulary while still in the message rows, and only distinct (case, known word) pairs
    are shuffled, at most a vocabulary per case. They become one row per case, in which leaves are counted, so no task
    holds rows of (case, leaf). The lists of leaves by word come through the driver: they are as large as the taxonomy.
    """
    leaves, words_of = numbered_leaves(taxonomy)
    known = small(words_of.select("word", "_known"))
    words = F.array_distinct(F.split(F.lower(F.coalesce("message", F.lit(""))), "[^a-z0-9]+"))
    rows = assigned_only(labelled).select("case_number", F.explode(words).alias("word"))
    pairs = rows.join(known, ["word"], "left").select("case_number", "_known").distinct()
    said = pairs.groupBy("case_number").agg(F.collect_list("_known").alias("_words"))
    lists, sizes = constant(words_of.orderBy("_known"), "_leaves", "array<array<int>>"), constant(leaves.orderBy("_leaf"), "n_words", "array<int>")
    hits = F.sort_array(F.flatten(F.transform("_words", lambda w: F.get(lists, w))))

    def count(state: Column, leaf: Column) -> Column:
        """A run of equal leaves is a leaf's words; the first leaf of the best score stays."""
        n = F.when(state["leaf"] == leaf, state["n"] + 1).otherwise(F.lit(1))
        score = n / F.get(sizes, leaf)
        better = score > state["score"]
        return F.struct(
            leaf.alias("leaf"), n.alias("n"), F.when(better, score).otherwise(state["score"]).alias("score"),
            F.when(better, leaf).otherwise(state["best"]).alias("best"))

    none = F.struct(F.lit(-1).alias("leaf"), F.lit(0).alias("n"), F.lit(0.0).alias("score"), F.lit(-1).alias("best"))
    best = said.select("case_number", F.aggregate(hits, none, count).alias("_b"))
    named = best.join(small(leaves.select(F.col("_leaf").alias("_best"), "primary", "secondary")), F.col("_b.best") == F.col("_best"), "left")
    found = named.select(
        "case_number",
        F.coalesce("primary", F.lit("Other")).alias("primary"),
        F.coalesce("secondary", F.lit("Other")).alias("secondary"),
        F.round("_b.score", 3).alias("confidence"),
    )
    return found.withColumn("category", text.combine_category(F.col("primary"), F.col("secondary")))


def candidate_leaves(labelled: DataFrame, taxonomy: DataFrame, k: int = 20, fallback: tuple[str, str] = ("Other", "Other")) -> DataFrame:
    """`case_number, primary_no, leaf_no, primary, secondary, score, rank`: the `k` leaves of each case it fits best.

    A leaf is found by its rarest word (`leaf_index`) and scored by the share of its words that the case has; ties go to
    the leaf with more words, then by taxonomy order. The fallback leaf comes last (score 0.0), unless it is among the
    `k`; a taxonomy without it offers none. The taxonomy may have any size: it is an inverted index that words of cases
    are joined with, and what moves per case is its distinct known words and the leaves that they are the rarest word of.
    """
    leaves = leaf_index(taxonomy)
    known = leaves.select(F.explode("words").alias("word")).distinct()
    words = F.array_distinct(F.split(F.lower(F.coalesce("message", F.lit(""))), "[^a-z0-9]+"))
    cases = assigned_only(labelled)
    said = cases.select("case_number", F.explode(words).alias("word")).join(small(known), ["word"], "left_semi").distinct()
    place = ["case_number", "primary_no", "leaf_no", "primary", "secondary"]
    found = said.join(small(leaves.withColumnRenamed("key", "word")), ["word"]).select(
        *place, F.size("words").alias("_n"), F.explode("words").alias("word"))
    hits = found.join(said, ["case_number", "word"]).groupBy(*place, "_n").agg(F.count(F.lit(1)).alias("_hits"))
    score = F.round(F.col("_hits") / F.col("_n"), 6)
    order = Window.partitionBy("case_number").orderBy(F.desc("score"), F.desc("_hits"), "primary_no", "leaf_no")
    top = hits.withColumn("score", score).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = top.select(*place, "score", "rank")
    last = taxonomy.where((F.col("primary") == fallback[0]) & (F.col("secondary") == fallback[1])).agg(
        F.min(F.struct("primary_no", "leaf_no")).alias("place")).first()["place"]
    if last is None:
        return best
    both = best.unionByName(cases.select("case_number").distinct().select(
        "case_number", F.lit(last.primary_no).alias("primary_no"), F.lit(last.leaf_no).alias("leaf_no"),
        F.lit(fallback[0]).alias("primary"), F.lit(fallback[1]).alias("secondary"), F.lit(0.0).alias("score"), F.lit(k + 1).alias("rank")))
    return both.groupBy(*place).agg(F.max("score").alias("score"), F.min("rank").alias("rank"))


def sorted_classifications(classifications: DataFrame) -> DataFrame:
    return classifications.orderBy(F.desc("confidence"), "case_number")
