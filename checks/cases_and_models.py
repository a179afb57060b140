"""Queries: reply parsing, request tables, model-assisted jobs."""

import pandas as pd
from pyspark.sql import functions as F

from checks import adapters as a, bases as b
from checks.ctes import line, sql, text as quoted
from checks.registry import query
from convocases.operators import classify, replies as r, review, taxonomy
from convocases.plans import pipeline, requests

# ---- replies


@query("extract_json", sql("""
SELECT 'segment:' || channel_url || ':0' AS request_id, CASE WHEN status = 'error' THEN NULL ELSE
  CASE v WHEN 1 THEN 'tag' WHEN 2 THEN 'fence' WHEN 3 THEN 'braces' WHEN 4 THEN 'object' ELSE 'whole' END END AS branch
FROM r1 WHERE status <> 'missing'""", "r1"))
def extract_json(spark, sf):
    rows = a.r1_replies(spark, sf).withColumns(r.extract_json(F.col("content")))
    return rows.select("request_id", "branch")


@query("extract_json_classification", sql("""
SELECT 'classify:' || case_number AS request_id, CASE v WHEN 5 THEN 'tag' WHEN 6 THEN NULL ELSE 'object' END AS branch FROM r3""", "r3"))
def extract_json_classification(spark, sf):
    rows = a.r3_replies(b.segmented(spark, sf).cases).withColumns(r.extract_json_classification(F.col("content")))
    return rows.select("request_id", "branch")


@query("validate_segmentation", sql("""
SELECT 'segment:' || channel_url || ':0' AS request_id, CASE WHEN status = 'error' THEN 'no_json' WHEN v = 4 THEN 'no_case_list' WHEN v = 6 THEN 'missing_key' END AS reason,
  CASE WHEN status = 'ok' THEN 2 ELSE NULL END::BIGINT AS n_cases FROM r1 WHERE status <> 'missing'""", "r1"))
def validate_segmentation(spark, sf):
    rows = r.validate_segmentation(a.r1_replies(spark, sf))
    return rows.select("request_id", "reason", F.when(F.col("cases").isNotNull(), F.size("cases")).cast("long").alias("n_cases"))


@query("validate_review", sql("""
SELECT channel_url, case_index, CASE WHEN v = 3 THEN 'bad_needs_split' END AS reason, CASE v WHEN 1 THEN '2' WHEN 2 THEN '99,0,-3' WHEN 5 THEN '2,2' WHEN 6 THEN '1' ELSE '' END AS points
FROM r2 WHERE v <> 4""", "r2"))
def validate_review(spark, sf):
    rows = r.validate_review(a.r2_replies(b.boundaries(spark, sf), 0))
    return rows.select("channel_url", "case_index", "reason", F.array_join(F.col("points").cast("array<string>"), ",").alias("points"))


@query("validate_classification", sql("""
SELECT 'classify:' || r.case_number AS request_id, CASE v WHEN 1 THEN 'bad_primary' WHEN 2 THEN 'bad_secondary' WHEN 4 THEN 'missing_key' WHEN 6 THEN 'no_json' END AS reason,
  k.category, k.confidence::DOUBLE AS confidence FROM r3 r LEFT JOIN classified k USING (case_number)""", "r3", "classified"))
def validate_classification(spark, sf):
    replies = a.r3_replies(b.segmented(spark, sf).cases)
    rows = classify.validate_classification(replies, taxonomy.taxonomy_table(spark))
    return rows.select("request_id", "reason", "category", "confidence")


@query("explode_cases", sql("""
SELECT channel_url, case_index, start_pos, end_pos, summary, confidence::DOUBLE AS confidence FROM proposed
WHERE channel_url IN (SELECT channel_url FROM r1 WHERE status = 'ok')""", "proposed"))
def explode_cases(spark, sf):
    rows = r.explode_cases(r.validate_segmentation(a.r1_replies(spark, sf).drop("case_index")))
    return rows.select("channel_url", "case_index", "start_pos", "end_pos", "summary", "confidence")


@query("fallback_case", sql("""
SELECT channel_url, start_pos, end_pos, summary, confidence::DOUBLE AS confidence FROM proposed
WHERE channel_url IN (SELECT channel_url FROM r1 WHERE status <> 'ok')""", "proposed"))
def fallback_case(spark, sf):
    rows = r.fallback_cases(r.join_replies(b.m1_requests(spark, sf), a.r1_replies(spark, sf)))
    return rows.select("channel_url", "start_pos", "end_pos", "summary", "confidence")


# ---- model-assisted jobs


@query("segmentation_requests", sql(f"""
, t AS (SELECT channel_url, count(*) AS n_messages, {quoted(requests.SEGMENT_TASK)} || string_agg({line('pos')}, '' ORDER BY pos) AS prompt FROM m1_pos GROUP BY 1)
SELECT 'segment:' || channel_url || ':0' AS request_id, channel_url, n_messages, prompt, length(prompt) // 4 AS prompt_tokens FROM t""", "m1_pos"))
def segmentation_requests(spark, sf):
    return b.m1_requests(spark, sf).select("request_id", "channel_url", "n_messages", "prompt", "prompt_tokens")


def echo(batch: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a model: fails for a third of the requests, else tells the prompt's length."""
    number = batch["channel_url"].str.split("_").str[-1].astype(int)
    out = pd.DataFrame({
        "request_id": batch["request_id"], "content": batch["prompt"].str.len().astype(str),
        "input_tokens": batch["prompt_tokens"], "output_tokens": 1, "model": "echo", "provider": "none", "seconds": 0.0,
    })
    return out[number % 3 != 0]


@query("map_requests", sql(f"""
SELECT 'segment:' || channel_url || ':0' AS request_id, CASE WHEN conv_id % 3 <> 0 THEN len::VARCHAR END AS content, CASE WHEN conv_id % 3 = 0 THEN 'no reply' END AS error
FROM (SELECT channel_url, conv_id, length({quoted(requests.SEGMENT_TASK)} || string_agg({line('pos')}, '' ORDER BY pos)) AS len FROM m1_pos GROUP BY 1, 2)""", "m1_pos"))
def map_requests(spark, sf):
    replies = requests.map_requests(b.m1_requests(spark, sf), echo, concurrency=4)
    return replies.select("request_id", "content", "error")


@query("segment_with_replies", sql("""
SELECT message_id, case_number, case_summary, round(case_confidence::DOUBLE, 6) AS case_confidence FROM labelled""", "labelled"))
def segment_with_replies(spark, sf):
    done = pipeline.segment_with_replies(a.m1(spark, sf), a.r1_replies(spark, sf))
    return done.messages.select("message_id", "case_number", "case_summary", "case_confidence")


CASE_LINE = line("(pos - start_pos + 1)")


@query("review_requests", sql(f"""
SELECT 'review:0:' || channel_url || ':' || case_index || ':0' AS request_id, channel_url, case_index, count(*) AS n_messages,
  {quoted(requests.REVIEW_TASK)} || string_agg({CASE_LINE}, '' ORDER BY pos) AS prompt FROM case_rows GROUP BY 1, 2, 3""", "case_rows"))
def review_requests(spark, sf):
    rows = requests.review_requests(b.boundaries(spark, sf), b.m1_pos(spark, sf))
    return rows.select("request_id", "channel_url", "case_index", "n_messages", "prompt")


@query("review_loop", sql("""
, per AS (SELECT channel_url, any_value(v) AS v, count(*) AS k FROM r2 GROUP BY 1)
SELECT f.channel_url, case_index, start_pos, end_pos, summary, confidence::DOUBLE AS confidence,
  CASE WHEN v IN (1, 2, 5, 6) THEN 1 ELSE 0 END AS review_iterations, CASE WHEN v IN (1, 2, 5, 6) THEN k ELSE 0 END AS cases_reviewed,
  CASE WHEN v IN (1, 2, 5, 6) THEN k ELSE 0 END AS cases_split FROM refined f JOIN per USING (channel_url)""", "refined", "r2"))
def review_loop(spark, sf):
    cases, counters = review.review_loop(b.boundaries(spark, sf), a.r2_replies)
    rows = cases.join(counters, ["channel_url"])
    return rows.select(
        "channel_url", "case_index", "start_pos", "end_pos", "summary", "confidence", "review_iterations",
        "cases_reviewed", "cases_split",
    )


EXCERPT_LINE = (
    "'**Message ' || case_pos || '** [' || sender_type || '] (' || sender_id || ') (' || strftime(created_time, '%Y-%m-%d %H:%M:%S') || '): ' || message"
)


def taxonomy_text() -> str:
    return "\n".join(f"**{p}:**\n" + "\n".join(f"  - {s}" for s in ss) + "\n" for p, ss in taxonomy.TAXONOMY.items())


@query("classification_requests", sql(f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY created_time, ingest_seq, message_id) AS case_pos FROM labelled WHERE case_number <> '')
SELECT 'classify:' || case_number AS request_id, case_number, count(*) AS n_messages, {quoted(requests.CLASSIFY_TASK)}
  || 'Case: ' || case_number || chr(10) || 'Summary: ' || any_value(case_summary) || chr(10)
  || 'Duration: ' || printf('%.1f', round_even(any_value(case_duration_minutes), 1)) || ' minutes' || chr(10) || 'Messages: ' || count(*) || chr(10) || chr(10)
  || string_agg({EXCERPT_LINE}, chr(10) || chr(10) ORDER BY case_pos) || chr(10) || chr(10) || {quoted(taxonomy_text())} AS prompt
FROM ranked GROUP BY case_number""", "labelled"))
def classification_requests(spark, sf):
    rows = requests.classification_requests(b.segmented(spark, sf).messages, taxonomy.taxonomy_table(spark))
    return rows.select("request_id", "case_number", "n_messages", "prompt")


@query("classify_with_replies", sql("""
SELECT message_id, case_number, category, round(classification_confidence::DOUBLE, 6) AS classification_confidence, classification_reasoning FROM final""", "final"))
def classify_with_replies(spark, sf):
    done = b.segmented(spark, sf)
    rows = pipeline.classify_with_replies(done.messages, a.r3_replies(done.cases), classified_at=b.at())
    return rows.select("message_id", "case_number", "category", "classification_confidence", "classification_reasoning")


LEAF_WORDS = """
, leaf_words AS (SELECT prim, sec, list_distinct(list_filter(regexp_split_to_array(lower(prim || ' ' || sec), '[^a-z0-9]+'), lambda w: w NOT IN ('', 'and', 'by', 'not', 'other'))) AS words FROM taxonomy),
leaf AS (SELECT prim, sec, len(words) AS n_words, unnest(words) AS word FROM leaf_words)"""


@query("classify_by_rules", sql(f"""{LEAF_WORDS},
words AS (SELECT DISTINCT case_number, unnest(regexp_split_to_array(lower(message), '[^a-z0-9]+')) AS word FROM m3_labelled),
scores AS (SELECT case_number, prim, sec, count(*) / n_words AS score FROM words JOIN leaf USING (word) GROUP BY case_number, prim, sec, n_words),
best AS (SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY score DESC, prim, sec) AS rn FROM scores)
SELECT c.case_number, coalesce(prim, 'Other') AS primary_name, coalesce(sec, 'Other') AS secondary_name, round(coalesce(score, 0), 3)::DOUBLE AS confidence
FROM m3_cases c LEFT JOIN best b ON c.case_number = b.case_number AND rn = 1""", "m3_labelled", "m3_cases", "taxonomy"))
def classify_by_rules(spark, sf):
    rows = classify.classify_by_rules(b.m3_rules(spark, sf).messages, taxonomy.taxonomy_table(spark))
    return rows.selectExpr("case_number", "primary as primary_name", "secondary as secondary_name", "confidence")


CANDIDATES = f"""{LEAF_WORDS}
, frequency AS (SELECT word, count(*) AS leaves FROM leaf GROUP BY word)
, keyed AS (SELECT prim, sec, any_value(n_words) AS n_words, arg_min(word, (leaves, word)) AS key FROM leaf JOIN frequency USING (word) GROUP BY prim, sec)
, said AS (SELECT DISTINCT case_number, unnest(regexp_split_to_array(lower(message), '[^a-z0-9]+')) AS word FROM labelled WHERE case_number <> '')
, hits AS (SELECT s.case_number, k.prim, k.sec, any_value(k.n_words) AS n, count(*) AS hits FROM said s JOIN keyed k ON k.key = s.word
  JOIN leaf l ON l.prim = k.prim AND l.sec = k.sec JOIN said w ON w.case_number = s.case_number AND w.word = l.word GROUP BY 1, 2, 3)
, placed AS (SELECT h.*, t.leaf AS no, round(hits / n, 6) AS score FROM hits h JOIN taxonomy t USING (prim, sec))
, top AS (SELECT case_number, no, prim, sec, score, row_number() OVER (PARTITION BY case_number ORDER BY score DESC, hits DESC, no) AS rank FROM placed)
, offered AS (SELECT case_number, no, prim, sec, max(score) AS score, min(rank) AS rank FROM (SELECT * FROM top WHERE rank <= 5
  UNION ALL SELECT DISTINCT case_number, leaf, prim, sec, 0, 6 FROM labelled, taxonomy WHERE case_number <> '' AND prim = 'Other' AND sec = 'Other') GROUP BY ALL)"""


@query("candidate_leaves", sql(f"""{CANDIDATES}
SELECT case_number, prim AS primary_name, sec AS secondary_name, score::DOUBLE AS score, rank::INT AS place FROM offered""", "labelled", "taxonomy"))
def candidate_leaves(spark, sf):
    rows = classify.candidate_leaves(b.segmented(spark, sf).messages, taxonomy.taxonomy_table(spark), k=5)
    return rows.selectExpr("case_number", "primary as primary_name", "secondary as secondary_name", "score", "rank as place")


@query("classification_requests_of_candidates", sql(f"""{CANDIDATES}
, blocks AS (SELECT case_number, min(no) AS first_no, '**' || prim || ':**' || chr(10) || string_agg('  - ' || sec, chr(10) ORDER BY no) || chr(10) AS block
  FROM offered GROUP BY case_number, prim)
, named AS (SELECT case_number, string_agg(block, chr(10) ORDER BY first_no) AS names FROM blocks GROUP BY case_number)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY created_time, ingest_seq, message_id) AS case_pos FROM labelled WHERE case_number <> '')
SELECT 'classify:' || case_number AS request_id, {quoted(requests.CLASSIFY_TASK)}
  || 'Case: ' || case_number || chr(10) || 'Summary: ' || any_value(case_summary) || chr(10)
  || 'Duration: ' || printf('%.1f', round_even(any_value(case_duration_minutes), 1)) || ' minutes' || chr(10) || 'Messages: ' || count(*) || chr(10) || chr(10)
  || string_agg({EXCERPT_LINE}, chr(10) || chr(10) ORDER BY case_pos) || chr(10) || chr(10) || any_value(names) AS prompt
FROM ranked JOIN named USING (case_number) GROUP BY case_number""", "labelled", "taxonomy"))
def classification_requests_of_candidates(spark, sf):
    """Prompts that name five leaves and the fallback, instead of the whole taxonomy."""
    rows = requests.classification_requests(b.segmented(spark, sf).messages, taxonomy.taxonomy_table(spark), leaves_per_case=5)
    return rows.select("request_id", "prompt")


@query("run_pipeline", sql("""
SELECT message_id, case_number, category, round(case_confidence::DOUBLE, 6) AS case_confidence, case_summary,
  round(classification_confidence::DOUBLE, 6) AS classification_confidence, message FROM final""", "final"))
def run_pipeline(spark, sf):
    raw = a.m1_raw(spark, sf)
    run = pipeline.run_pipeline(
        raw, segmentation_replies=a.r1_replies(spark, sf), classified_at=b.at(),
        classification_replies=a.r3_replies(b.segmented(spark, sf).cases),
    )
    return run.messages.select(
        "message_id", "case_number", "category", "case_confidence", "case_summary", "classification_confidence", "message")


@query("retry_failed_requests", sql(f"""
SELECT 'segment:' || channel_url || ':0' AS request_id, CASE WHEN status IN ('ok', 'invalid') THEN 'first' WHEN conv_id % 3 <> 0 THEN 'echo' ELSE 'last' END AS answered_by,
  CAST(NULL AS VARCHAR) AS error FROM r1""", "r1"))
def retry_failed_requests(spark, sf):
    def last(batch):
        return pd.DataFrame({"request_id": batch["request_id"], "content": "x", "model": "last"})

    first = a.r1_replies(spark, sf).select(
        "request_id", "content", "input_tokens", "output_tokens", F.lit("first").alias("model"), "provider", "seconds", "error")
    rows = requests.retry_failed_requests(b.m1_requests(spark, sf), first, [echo, last], concurrency=4)
    return rows.select("request_id", F.col("model").alias("answered_by"), "error")
