"""Candidate leaves of a case from taxonomies of any size, and the prompts that name them."""

import re

import pytest
from pyspark.sql import functions as F

from convocases.operators import classify, taxonomy
from convocases.plans import requests

LEAVES = [("Order", "Order - Status"), ("Order", "Order - Cancel"), ("Shipment", "Shipment - Status"), ("Shipment", "Shipment - Delay"),
          ("Shipment", "Delay - Shipment"), ("User", "Update - Email"), ("Other", "Not - By"), ("Other", "Other")]
MESSAGES = [
    ("1", "shipment delay, my order STATUS"), ("1", "email? update"), ("2", "nothing here"), ("3", None), ("4", ""), ("", "order status"),
    ("5", "status"), ("6", "shipment order user update"), ("7", "delay shipment " * 50), ("7", "status"),
]


def messages(spark, rows):
    full = [(f"CASE_{c}" if c else "", m, i, str(i), "u", "user", "s", 1.0, "junk", 7) for i, (c, m) in enumerate(rows)]
    return spark.createDataFrame(
        full, "case_number string, message string, ingest_seq long, message_id string, sender_id string, sender_type string, "
        "case_summary string, case_duration_minutes double, word string, rank int",
    ).withColumn("created_time", F.timestamp_seconds("ingest_seq"))


def table(spark, leaves):
    numbers = {p: i for i, p in reversed(list(enumerate(p for p, _ in leaves)))}
    return spark.createDataFrame([(numbers[p], i, p, s) for i, (p, s) in enumerate(leaves)],
                                 "primary_no int, leaf_no int, primary string, secondary string")


def plain(rows, leaves, k):
    split = lambda t: {w for w in re.split("[^a-z0-9]+", t.lower()) if w}
    words = {leaf: split(" ".join(leaf)) - set(taxonomy.STOP_WORDS) for leaf in leaves}
    often = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}
    numbers = {p: i for i, p in reversed(list(enumerate(p for p, _ in leaves)))}
    out = {}
    for case in {c for c, _ in rows if c}:
        said = set().union(*(split(m or "") for c, m in rows if c == case))
        found = []
        for i, leaf in reversed(list(enumerate(leaves))):
            if words[leaf] and min(words[leaf], key=lambda w: (often[w], w)) in said:
                hits = len(words[leaf] & said)
                found.append((-round(hits / len(words[leaf]), 6), -hits, numbers[leaf[0]], leaves.index(leaf), leaf))
        own = [x[-1] for x in sorted(set(found))[:k]]
        last = [("Other", "Other")] if ("Other", "Other") in leaves and ("Other", "Other") not in own else []
        out[f"CASE_{case}"] = own + last
    return out


def found(df):
    rows = sorted((r.case_number, r["rank"], r.primary, r.secondary) for r in df.collect())
    out = {}
    for case, _, *leaf in rows:
        out.setdefault(case, []).append(tuple(leaf))
    return out


@pytest.mark.parametrize("k", [1, 2, 20])
def test_candidates_against_plain_python(spark, k):
    got = found(classify.candidate_leaves(messages(spark, MESSAGES), table(spark, LEAVES + LEAVES[:2]), k))
    assert got == plain(MESSAGES, LEAVES, k)
    assert all(len(x) <= k + 1 for x in got.values()) and got["CASE_2"] == got["CASE_3"] == [("Other", "Other")]


def test_taxonomies_without_fallback_and_empty_tables(spark):
    rows, few = messages(spark, MESSAGES), table(spark, LEAVES[:2])
    assert found(classify.candidate_leaves(rows, few)) == {c: x for c, x in plain(MESSAGES, LEAVES[:2], 20).items() if x}
    assert classify.candidate_leaves(rows, few.where("false")).count() == 0
    assert classify.candidate_leaves(rows.where("false"), few).count() == 0
    none = requests.classification_requests(rows, few.where("false"), leaves_per_case=3)
    assert none.count() == 7 and all(r.prompt.endswith("\n\n") for r in none.collect())


def test_text_of_leaves_is_that_of_the_taxonomy(spark):
    names = taxonomy.taxonomy_table(spark)
    one = names.groupBy().agg(taxonomy.format_leaves(F.collect_list(F.struct("primary_no", "leaf_no", "primary", "secondary"))).alias("t"))
    assert one.first()["t"] == taxonomy.format_taxonomy(names).first()["taxonomy_text"]


def test_fifty_thousand_leaves_make_bounded_prompts(spark):
    large = spark.range(50_000).select(
        F.floor(F.col("id") / 500).cast("int").alias("primary_no"), (F.col("id") % 500).cast("int").alias("leaf_no"),
        F.format_string("Group %d", F.floor(F.col("id") / 500)).alias("primary"),
        F.format_string("Update - Part x%d", F.col("id")).alias("secondary"))
    rows = messages(spark, [(str(i % 50), f"please update part x{i * 7 % 50_000} in group {i % 3}") for i in range(2_000)])
    with pytest.raises(ValueError):
        requests.classification_requests(rows, large)
    asked = requests.classification_requests(rows, large, leaves_per_case=5).collect()
    assert len(asked) == 50
    for r in asked:
        named = re.findall(r"  - Update - Part (x\d+)\n", r.prompt)
        assert len(named) == 5 and len(r.prompt) < 10_000
    case = {r.case_number: r.prompt for r in asked}["CASE_7"]
    assert {f"x{i * 7}" for i in range(7, 2_000, 50)} >= set(re.findall(r"Part (x\d+)\n", case))


def test_rules_count_leaves_within_a_case(spark):
    """A row for each case, not for each case and leaf; the score is that of the plain definition, ties go by name."""
    table = spark.createDataFrame(
        [(0, 0, "Order", "Lost item"), (0, 1, "Order", "Item"), (1, 0, "Aid", "Order item"), (2, 0, "Other", "Other"), (1, 1, "Aid", "Alpha beta")],
        "primary_no int, leaf_no int, primary string, secondary string")
    said = {"C1": ["my order", "an ITEM, an item"], "C2": ["beta"], "C3": ["", None], "C4": ["aid: order the lost item"], "": ["order"]}
    rows = [(case, text) for case, texts in said.items() for text in texts]
    found = classify.classify_by_rules(spark.createDataFrame(rows, "case_number string, message string"), table)
    words = {tuple(r[2:]): {w for w in re.split("[^a-z0-9]+", f"{r[2]} {r[3]}".lower()) if w not in ("", "other")} for r in table.collect()}
    expected = {}
    for case, texts in said.items():
        have = {w for t in texts for w in re.split("[^a-z0-9]+", (t or "").lower())}
        scores = sorted((-len(ws & have) / len(ws), *leaf) for leaf, ws in words.items() if ws & have)
        expected[case] = (*scores[0][1:], round(-scores[0][0], 3)) if scores else ("Other", "Other", 0.0)
    del expected[""]
    assert {r.case_number: (r.primary, r.secondary, r.confidence) for r in found.collect()} == expected
    assert not re.search(r"keys=\[case_number#\w+, primary", found._jdf.queryExecution().executedPlan().toString())
