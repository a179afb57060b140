"""Queries: joins, aggregates, ordered operators, sorts, set operations."""

from pyspark.sql import functions as F

from checks import adapters as a, bases as b
from checks.ctes import band, percent_label, sql
from checks.registry import query
from convocases.operators import (
    blocks, cases as c, channels, classify, context, messages as m, review, segment, stats, taxonomy,
)
from convocases.plans import pipeline
from convocases.sources import sinks

# ---- flagship


@query("flagship", sql("""
SELECT channel_url, count(*) AS cases, round(avg(duration_minutes), 3) AS mean_minutes FROM m2_cases GROUP BY 1""", "m2_cases"))
def flagship(spark, sf):
    cases = pipeline.rule_cases(a.m2(spark, sf), b.M2_RULES)
    return cases.groupBy("channel_url").agg(
        F.count("case_number").alias("cases"), F.round(F.avg("duration_minutes"), 3).alias("mean_minutes"))


# ---- joins


@query("cases_to_messages_range", sql("SELECT channel_url, case_index, pos, message_id FROM case_rows", "case_rows"))
def cases_to_messages_range(spark, sf):
    rows = c.cases_to_messages_range(b.boundaries(spark, sf), b.m1_pos(spark, sf))
    return rows.select("channel_url", "case_index", "pos", "message_id")


@query("assign_cases", sql("""
SELECT channel_url, message_id, case_number, case_start_time, case_end_time, round(case_duration_minutes, 6) AS case_duration_minutes,
  round(case_confidence::DOUBLE, 6) AS case_confidence, case_summary, false AS case_forced_ending, false AS case_forced_starting FROM labelled""", "labelled"))
def assign_cases(spark, sf):
    return b.segmented(spark, sf).messages.select(
        "channel_url", "message_id", "case_number", "case_start_time", "case_end_time", "case_duration_minutes",
        "case_confidence", "case_summary", "case_forced_ending", "case_forced_starting",
    )


@query("assign_categories", sql("""
SELECT message_id, case_number, category, round(classification_confidence::DOUBLE, 6) AS classification_confidence,
  classification_reasoning, classified_at FROM final""", "final"))
def assign_categories(spark, sf):
    return b.final(spark, sf).select(
        "message_id", "case_number", "category", "classification_confidence", "classification_reasoning", "classified_at")


@query("taxonomy_lookup", sql("""
SELECT case_number, CASE WHEN v = 1 THEN 'bad_primary' WHEN v = 2 THEN 'bad_secondary' END AS label_reason FROM r3 WHERE v NOT IN (4, 6)""", "r3"))
def taxonomy_lookup(spark, sf):
    read = classify.validate_classification(a.r3_replies(b.segmented(spark, sf).cases), taxonomy.taxonomy_table(spark))
    labels = read.where("primary is not null and (reason is null or reason like 'bad%')")
    found = classify.taxonomy_lookup(labels.select("case_number", "primary", "secondary"), taxonomy.taxonomy_table(spark))
    return found.select("case_number", "label_reason")


@query("review_lookup", sql("""
SELECT channel_url, case_index, CASE WHEN v NOT IN (3, 4) THEN v <> 0 END AS needs_split,
  CASE WHEN v NOT IN (3, 4) THEN rc END AS review_confidence, CASE WHEN v NOT IN (3, 4) THEN 'round 0' END AS reasoning FROM r2""", "r2"))
def review_lookup(spark, sf):
    cases = b.boundaries(spark, sf)
    found = review.review_lookup(cases, review.read_reviews(a.r2_replies(cases, 0)))
    return found.select("channel_url", "case_index", "needs_split", "review_confidence", "reasoning")


@query("label_writeback_lookup", sql("""
SELECT message_id, nullif(case_number, '') AS case_number, nullif(category, '') AS category FROM final""", "final"))
def label_writeback_lookup(spark, sf):
    return sinks.label_writeback_lookup(b.final(spark, sf))


# ---- aggregates


@query("channel_counts", sql("SELECT channel_url, count(*) AS n_messages FROM x1_raw WHERE channel_url <> '' GROUP BY 1", "x1_raw"))
def channel_counts(spark, sf):
    return channels.channel_counts(a.x1_raw(spark, sf))


BANDS = "CASE WHEN n > 50 THEN 'many' WHEN n >= 10 THEN 'medium' ELSE 'few' END"


@query("channel_size_bands", sql(f"""
, counts AS (SELECT channel_url, count(*) AS n FROM m3 GROUP BY 1)
SELECT {BANDS} AS size_band, count(*) AS channels, max(n) AS largest, round(avg(n), 6) AS mean FROM counts GROUP BY 1
UNION ALL SELECT 'all', count(*), max(n), round(avg(n), 6) FROM counts""", "m3"))
def channel_size_bands(spark, sf):
    return channels.channel_size_bands(channels.channel_counts(a.m3(spark, sf)))


@query("preprocess_stats", sql("""
, wanted AS (SELECT channel_url, count(*) FROM x1_raw WHERE channel_url <> '' GROUP BY 1 HAVING count(*) >= 4)
SELECT count(*) AS total_rows, count(*) FILTER (ok) AS processed_rows, count(*) FILTER (NOT ok) AS filtered_rows, 0::BIGINT AS error_rows,
  count(DISTINCT channel_url) FILTER (ok) AS channels_found, (SELECT count(*) FROM wanted) AS channels_selected
FROM (SELECT *, message_id <> '' AND channel_url <> '' AND channel_url IN (SELECT channel_url FROM wanted) AS ok FROM x1_raw)""", "x1_raw"))
def preprocess_stats(spark, sf):
    raw = a.x1_raw(spark, sf)
    chosen = channels.channel_counts(raw).where("n_messages >= 4")
    return stats.preprocess_stats(raw, chosen)


@query("channel_size_summary", sql("""
SELECT count(*) AS channels, min(n) AS min_messages, max(n) AS max_messages, round(avg(n), 6) AS avg_messages
FROM (SELECT count(*) AS n FROM m1 GROUP BY channel_url)""", "m1"))
def channel_size_summary(spark, sf):
    return channels.channel_size_summary(channels.channel_counts(a.m1(spark, sf)))


@query("build_cases", sql("""
SELECT channel_url, case_index, start_pos, end_pos, start_time, end_time, n_messages, round(duration_minutes, 6) AS duration_minutes,
  participants, summary, confidence::DOUBLE AS confidence FROM cases""", "cases"))
def build_cases(spark, sf):
    cases = c.cases_of_boundaries(b.boundaries(spark, sf), b.m1_pos(spark, sf))
    return cases.select(
        "channel_url", "case_index", "start_pos", "end_pos", "start_time", "end_time", "n_messages",
        "duration_minutes", F.array_join("participants", ";").alias("participants"), "summary", "confidence",
    )


CHANNEL_STATS = """
SELECT channel_url, n AS total_messages, coalesce(k, 0) AS cases_found,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE input_tokens END::BIGINT AS input_tokens,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE output_tokens END::BIGINT AS output_tokens,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE 1 END::BIGINT AS calls,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE seconds END::DOUBLE AS seconds,
  round(coalesce(cs, 0)::DOUBLE, 6) AS confidence_sum, 0::BIGINT AS review_iterations, 0::BIGINT AS cases_reviewed, 0::BIGINT AS cases_split
FROM r1 LEFT JOIN (SELECT channel_url, count(*) AS k, sum(confidence) AS cs FROM cases GROUP BY 1) USING (channel_url)"""


@query("channel_stats", sql(CHANNEL_STATS, "r1", "cases"))
def channel_stats(spark, sf):
    return b.channel_stats(spark, sf)


@query("total_stats", sql(f"""
, per_channel AS ({CHANNEL_STATS})
SELECT sum(cases_found)::BIGINT AS total_cases, count(*) AS total_channels, sum(input_tokens)::BIGINT AS total_input_tokens,
  sum(output_tokens)::BIGINT AS total_output_tokens, sum(input_tokens + output_tokens)::BIGINT AS total_tokens, sum(calls)::BIGINT AS total_calls,
  round(sum(seconds), 6) AS total_seconds, round((SELECT avg(confidence) FROM cases), 6) AS case_avg_confidence,
  0::BIGINT AS total_review_iterations, 0::BIGINT AS total_cases_reviewed, 0::BIGINT AS total_cases_split, 0::BIGINT AS channels_with_review
FROM per_channel""", "r1", "cases"))
def total_stats(spark, sf):
    return stats.total_stats(b.channel_stats(spark, sf))


@query("confidence_distribution", sql(f"""
SELECT {band('confidence')} AS band, count(*) AS cases, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM m2_cases), 6) AS share,
  {percent_label('count(*)', '(SELECT count(*) FROM m2_cases)')} AS label FROM m2_cases GROUP BY 1""", "m2_cases"))
def confidence_distribution(spark, sf):
    return stats.confidence_distribution(b.m2_rules(spark, sf).cases)


TOTAL = "(SELECT count(*) FROM classified)"


@query("category_distribution", sql(f"""
SELECT category, cases, round(cases * 100.0::DOUBLE / {TOTAL}, 6) AS share, {percent_label('cases', TOTAL)} AS label FROM categories""", "categories"))
def category_distribution(spark, sf):
    return stats.category_distribution(b.classifications(spark, sf))


@query("primary_distribution", sql(f"""
SELECT primary_name, cases, round(cases * 100.0::DOUBLE / {TOTAL}, 6) AS share, {percent_label('cases', TOTAL)} AS label FROM primaries""", "primaries"))
def primary_distribution(spark, sf):
    return stats.primary_distribution(b.classifications(spark, sf)).withColumnRenamed("primary", "primary_name")


@query("category_insights", sql("""
, c AS (SELECT * FROM categories ORDER BY cases DESC, category LIMIT 1), p AS (SELECT * FROM primaries ORDER BY cases DESC, primary_name LIMIT 1)
SELECT c.category AS most_common_category, c.cases AS category_cases, p.primary_name AS most_common_primary, p.cases AS primary_cases,
  (SELECT count(*) FROM categories) AS unique_categories, (SELECT count(*) FROM primaries) AS unique_primaries FROM c, p""", "categories", "primaries"))
def category_insights(spark, sf):
    return stats.category_insights(b.classifications(spark, sf))


@query("channel_case_summary", sql("""
SELECT channel_url, count(*) AS cases, round(avg(confidence), 6) AS avg_confidence, round(sum(duration_minutes), 6) AS total_minutes,
  0::BIGINT AS review_iterations, 0::BIGINT AS cases_reviewed, 0::BIGINT AS cases_split, 'none' AS review_status FROM cases GROUP BY 1""", "cases"))
def channel_case_summary(spark, sf):
    return stats.channel_case_summary(b.segmented(spark, sf).cases, b.channel_stats(spark, sf))


SUMMARY = """
SELECT (SELECT count(*) FROM m1_raw) AS input_rows, count(*) AS output_rows, count(DISTINCT channel_url) AS channels,
  count(DISTINCT case_number) FILTER (case_number <> '') AS unique_cases, avg(case_confidence::DOUBLE) AS row_avg_confidence,
  count(DISTINCT case_number) FILTER (case_number <> '' AND category <> '') AS classified_cases,
  count(DISTINCT category) FILTER (category <> '') AS unique_categories,
  avg(classification_confidence::DOUBLE) FILTER (classification_confidence > 0) AS avg_classification_confidence FROM final"""
ROUNDED = """input_rows, output_rows, channels, unique_cases, round(row_avg_confidence, 6) AS row_avg_confidence, classified_cases, unique_categories,
  round(avg_classification_confidence, 6) AS avg_classification_confidence, round(classified_cases::DOUBLE / unique_cases, 6) AS coverage"""


@query("pipeline_summary", sql(f", s AS ({SUMMARY}) SELECT {ROUNDED} FROM s", "final"))
def pipeline_summary(spark, sf):
    return stats.pipeline_summary(a.m1_raw(spark, sf), b.final(spark, sf))


def verdict_sql(table):
    return f"""SELECT '{table}' AS subject, count(*) AS total_cases, avg(confidence)::DOUBLE AS m, count(*) FILTER (confidence < 0.5) AS low_cases,
  count(*) FILTER (confidence >= 0.8) AS high_cases FROM {table}"""


@query("quality_verdicts", sql(f"""
, v AS ({verdict_sql('cases')} UNION ALL {verdict_sql('classified')}), s AS ({SUMMARY})
SELECT subject, total_cases, low_cases, high_cases, round(m, 6) AS avg_confidence, CASE WHEN m >= 0.7 THEN 'good' WHEN m >= 0.5 THEN 'moderate' ELSE 'poor' END AS quality,
  low_cases > total_cases * 0.3 AS low_warning, high_cases > total_cases * 0.7 AS high_praise, low_cases > 0 AS review_low, m < 0.6 AS improve_model,
  CASE WHEN subject = 'classified' THEN (SELECT max(cases) FROM primaries) > total_cases * 0.5 END AS imbalanced,
  CASE WHEN row_avg_confidence >= 0.8 THEN 'high' WHEN row_avg_confidence >= 0.6 THEN 'medium' ELSE 'low' END AS segmentation_grade,
  CASE WHEN classified_cases / unique_cases >= 0.9 THEN 'high' WHEN classified_cases / unique_cases >= 0.7 THEN 'medium' ELSE 'low' END AS coverage_grade
FROM v, s""", "cases", "classified", "primaries", "final"))
def quality_verdicts(spark, sf):
    seg = stats.confidence_verdicts(b.segmented(spark, sf).cases).withColumns(
        {"subject": F.lit("cases"), "imbalanced": F.lit(None).cast("boolean")})
    cls = stats.classification_verdicts(b.classifications(spark, sf)).withColumn("subject", F.lit("classified"))
    whole = stats.pipeline_verdicts(stats.pipeline_summary(a.m1_raw(spark, sf), b.final(spark, sf)))
    grades = whole.select("segmentation_grade", "coverage_grade")
    subjects = grades.select("*", F.explode(F.array(F.lit("cases"), F.lit("classified"))).alias("subject"))
    return seg.unionByName(cls).join(subjects, ["subject"])


@query("token_usage", sql("""
SELECT CASE grouping(channel_url, provider, model) WHEN 3 THEN 'channel' WHEN 4 THEN 'model' ELSE 'all' END AS level, channel_url, provider, model,
  sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, count(*) AS calls, round(sum(seconds)::DOUBLE, 6) AS seconds
FROM r1 WHERE status NOT IN ('missing', 'error') GROUP BY GROUPING SETS ((channel_url), (provider, model), ())""", "r1"))
def token_usage(spark, sf):
    return stats.token_usage(a.r1_replies(spark, sf))


@query("compare_segmentations", sql("""
, x AS (SELECT channel_url, start_pos FROM cases WHERE start_pos > 1), y AS (SELECT channel_url, start_pos FROM m1_cases WHERE start_pos > 1),
k AS (SELECT (SELECT count(*) FROM x) AS cuts_a, (SELECT count(*) FROM y) AS cuts_b, (SELECT count(*) FROM x JOIN y USING (channel_url, start_pos)) AS cuts_both)
SELECT (SELECT count(*) FROM cases) AS cases_a, (SELECT count(*) FROM m1_cases) AS cases_b,
  round((SELECT avg(confidence) FROM cases), 6) AS avg_confidence_a, round((SELECT avg(confidence) FROM m1_cases), 6) AS avg_confidence_b,
  (SELECT sum(input_tokens + output_tokens) FROM r1 WHERE status NOT IN ('missing', 'error'))::BIGINT AS tokens_a, 0::BIGINT AS tokens_b,
  cuts_a, cuts_b, cuts_both, round(cuts_both::DOUBLE / cuts_b, 6) AS "precision", round(cuts_both::DOUBLE / cuts_a, 6) AS recall FROM k""", "cases", "m1_cases", "r1"))
def compare_segmentations(spark, sf):
    """Cases of the replies against cases by rules with a simple cue, on the same messages."""
    rules = c.cases_of_segments(segment.segment_by_rules(a.m1(spark, sf), rules=b.M1_RULES))
    replies = a.r1_replies(spark, sf).where("error is null")
    return segment.compare_segmentations(b.segmented(spark, sf).cases, rules, replies)


@query("compare_gap_settings", sql("""
, x AS (SELECT channel_url, start_pos FROM m2_cases WHERE start_pos > 1), y AS (SELECT channel_url, start_pos FROM m2_cases_short WHERE start_pos > 1),
k AS (SELECT (SELECT count(*) FROM x) AS cuts_a, (SELECT count(*) FROM y) AS cuts_b, (SELECT count(*) FROM x JOIN y USING (channel_url, start_pos)) AS cuts_both)
SELECT (SELECT count(*) FROM m2_cases) AS cases_a, (SELECT count(*) FROM m2_cases_short) AS cases_b,
  round((SELECT avg(confidence) FROM m2_cases), 6) AS avg_confidence_a, round((SELECT avg(confidence) FROM m2_cases_short), 6) AS avg_confidence_b,
  0::BIGINT AS tokens_a, 0::BIGINT AS tokens_b,
  cuts_a, cuts_b, cuts_both, round(cuts_both::DOUBLE / cuts_b, 6) AS "precision", round(cuts_both::DOUBLE / cuts_a, 6) AS recall FROM k""", "m2_cases", "m2_cases_short"))
def compare_gap_settings(spark, sf):
    short = c.cases_of_segments(segment.segment_by_rules(a.m2(spark, sf), rules=b.SHORT_RULES))
    return segment.compare_segmentations(b.m2_rules(spark, sf).cases, short)


# ---- ordered operators


@query("message_positions", sql("SELECT channel_url, message_id, pos FROM m3_pos", "m3_pos"))
def message_positions(spark, sf):
    return m.message_positions(a.m3(spark, sf)).select("channel_url", "message_id", "pos")


@query("number_cases", sql("SELECT channel_url, case_index, case_number FROM m3_cases", "m3_cases"))
def number_cases(spark, sf):
    return b.m3_rules(spark, sf).cases.select("channel_url", "case_index", "case_number")


@query("segment_by_rules", sql("""
SELECT channel_url, message_id, pos, rule, boundary_confidence, case_index FROM m3_seg
UNION ALL SELECT channel_url, message_id, pos, rule, boundary_confidence, case_index FROM m2_seg""", "m3_seg", "m2_seg"))
def segment_by_rules(spark, sf):
    columns = ("channel_url", "message_id", "pos", "rule", "boundary_confidence", "case_index")
    m2 = segment.segment_by_rules(a.m2(spark, sf), rules=b.M2_RULES)
    return b.m3_seg(spark, sf).select(*columns).unionByName(m2.select(*columns))


@query("time_gaps", sql("""
SELECT channel_url, message_id, round(gap / 1e6, 6) AS gap_seconds, CASE WHEN gap IS NULL THEN 'first' WHEN gap <= 14400000000 THEN 'session'
  WHEN gap <= 86400000000 THEN 'same_day_range' ELSE 'long' END AS gap_class, coalesce(created_time::DATE <> pt::DATE, false) AS crosses_day FROM m2_rule""", "m2_rule"))
def time_gaps(spark, sf):
    rows = segment.time_gaps(a.m2(spark, sf)).withColumn("gap_seconds", F.col("gap_minutes") * 60)
    return rows.select("channel_url", "message_id", "gap_seconds", "gap_class", "crosses_day")


RUNNING = "sum(length(message) // 4) OVER (PARTITION BY channel_url ORDER BY created_time, ingest_seq, message_id ROWS UNBOUNDED PRECEDING)"


@query("fit_token_budget", sql(f"""
SELECT channel_url, message_id, pos, running_tokens, total > 200 AS case_truncated FROM (
  SELECT *, ({RUNNING})::BIGINT AS running_tokens, sum(length(message) // 4) OVER (PARTITION BY channel_url) AS total FROM m3_pos) WHERE running_tokens <= 200""", "m3_pos"))
def fit_token_budget(spark, sf):
    kept = context.fit_token_budget(a.m3(spark, sf), max_context=250, reserve=50)
    return kept.select("channel_url", "message_id", "pos", "running_tokens", "case_truncated")


@query("force_boundaries", sql("""
, segs AS (SELECT channel_url, case_index AS s, min(pos) AS first_pos, count(*) AS len FROM m2_seg GROUP BY 1, 2),
rows_ AS (SELECT m.channel_url, m.message_id, m.pos, g.s, (m.pos - first_pos) // 3 AS piece, len, boundary_confidence FROM m2_seg m JOIN segs g ON m.channel_url = g.channel_url AND m.case_index = g.s),
pieces AS (SELECT channel_url, s, piece, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n_messages, any_value(len) AS len FROM rows_ GROUP BY 1, 2, 3)
SELECT channel_url, row_number() OVER (PARTITION BY channel_url ORDER BY start_pos) - 1 AS case_index, start_pos, end_pos, n_messages,
  piece > 0 AS forced_starting, (piece + 1) * 3 < len AS forced_ending, c.confidence
FROM pieces JOIN (SELECT channel_url, case_index AS s, max(boundary_confidence) AS confidence FROM m2_seg GROUP BY 1, 2) c USING (channel_url, s)""", "m2_seg"))
def force_boundaries(spark, sf):
    rows = segment.segment_by_rules(a.m2(spark, sf), rules=b.M2_RULES)
    cases = c.cases_of_segments(segment.force_boundaries(rows, 3))
    return cases.select("channel_url", "case_index", "start_pos", "end_pos", "n_messages", "forced_starting", "forced_ending", "confidence")


@query("sink_and_recent", sql("""
SELECT channel_url, message_id, pos, CASE WHEN pos <= 4 THEN 'sink' ELSE 'recent' END AS context_part FROM m3_pos WHERE pos <= 4 OR pos > n - 8""", "m3_pos"))
def sink_and_recent(spark, sf):
    return context.sink_and_recent(a.m3(spark, sf), 4, 12).select("channel_url", "message_id", "pos", "context_part")


@query("pair_coherence", """
WITH p AS (SELECT label, vec_id, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM embeddings)
SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], prev::DOUBLE[]), 6) AS coherence,
  coalesce(list_cosine_similarity(embedding::DOUBLE[], prev::DOUBLE[]) < 0.3, false) AS candidate_boundary FROM p""")
def pair_coherence(spark, sf):
    rows = context.pair_coherence(a.f8_vectors(spark, sf), ["label"], ["vec_id"])
    return rows.select("label", "vec_id", "coherence", "candidate_boundary")


COHERENCE = """
WITH v AS (SELECT 'label_' || label AS channel_url, vec_id, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM embeddings),
c AS (SELECT channel_url, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], prev::DOUBLE[]), 6) AS coherence FROM v),
f AS (SELECT *, CASE WHEN coalesce(lag(coherence) OVER w < coherence, true) THEN coherence END AS l,
  CASE WHEN coalesce(lead(coherence) OVER w < coherence, true) THEN coherence END AS r FROM c WINDOW w AS (PARTITION BY channel_url ORDER BY vec_id)),
d AS (SELECT channel_url, vec_id, coherence, CASE WHEN coherence IS NOT NULL THEN
  round(last_value(l IGNORE NULLS) OVER (PARTITION BY channel_url ORDER BY vec_id ROWS UNBOUNDED PRECEDING)
    + last_value(r IGNORE NULLS) OVER (PARTITION BY channel_url ORDER BY vec_id DESC ROWS UNBOUNDED PRECEDING) - 2 * coherence, 6) END AS depth FROM f)
"""


@query("coherence_depth", COHERENCE + "SELECT * FROM d")
def coherence_depth(spark, sf):
    rows = a.f8_vectors(spark, sf).withColumn("channel_url", F.format_string("label_%d", "label"))
    return context.coherence_depth(rows, ["channel_url"], ["vec_id"]).select("channel_url", "vec_id", "coherence", "depth")


@query("segment_by_coherence", COHERENCE + """
, m AS (SELECT channel_url, vec_id, CASE WHEN row_number() OVER (PARTITION BY channel_url ORDER BY vec_id) = 1 THEN 1 WHEN depth >= 0.6 THEN 6 END AS rule FROM d)
SELECT channel_url, vec_id, rule, (sum(CASE WHEN rule IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY channel_url ORDER BY vec_id ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS case_index,
  CASE rule WHEN 1 THEN 0.9 WHEN 6 THEN 0.4 END::DOUBLE AS boundary_confidence FROM m""")
def segment_by_coherence(spark, sf):
    """Cases of vectors, one a minute, where only a fall of coherence opens a new one."""
    rows = a.f8_vectors(spark, sf).withColumns({
        "channel_url": F.format_string("label_%d", "label"), "created_time": F.timestamp_seconds(F.lit(1704067200) + 60 * F.col("vec_id")),
        "ingest_seq": F.col("vec_id"), "message_id": F.col("vec_id").cast("string"), "message": F.lit("")})
    deep = context.coherence_depth(rows, ["channel_url"], ["vec_id"])
    found = segment.segment_by_rules(deep, rules=segment.Rules(depth=0.6, session_hours=10_000, day_hours=10_000))
    return found.select("channel_url", "vec_id", F.col("rule").cast("int").alias("rule"), "case_index", "boundary_confidence")


@query("case_head", sql("""
SELECT case_number, message_id, case_pos, greatest(k - 4, 0) AS remaining FROM (
  SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY created_time, ingest_seq, message_id) AS case_pos, count(*) OVER (PARTITION BY case_number) AS k FROM m3_labelled)
WHERE case_pos <= 4""", "m3_labelled"))
def case_head(spark, sf):
    head = c.case_head(b.m3_rules(spark, sf).messages, 4)
    return head.select("case_number", "message_id", F.col("case_pos").cast("long").alias("case_pos"), "remaining")


@query("apply_splits", sql("SELECT channel_url, case_index, start_pos, end_pos, summary, confidence::DOUBLE AS confidence FROM refined", "refined"))
def apply_splits(spark, sf):
    cases = b.boundaries(spark, sf)
    pieces = review.apply_splits(cases, review.read_reviews(a.r2_replies(cases, 0)))
    return review.renumber(pieces).select("channel_url", "case_index", "start_pos", "end_pos", "summary", "confidence")


@query("classifications_dedup", sql("""
SELECT case_number, category, confidence::DOUBLE AS confidence, reasoning, classified_at FROM classified
WHERE case_number IN (SELECT case_number FROM final)""", "final", "classified"))
def classifications_dedup(spark, sf):
    return classify.classifications_dedup(b.final(spark, sf))


@query("overlap_windows", sql("""
SELECT channel_url, message_id, pos, chunk FROM (
  SELECT *, unnest(generate_series(0::BIGINT, greatest(0, ceil((n - 8) / 6.0))::BIGINT)) AS chunk FROM m3_pos) WHERE pos > chunk * 6 AND pos <= chunk * 6 + 8""", "m3_pos"))
def overlap_windows(spark, sf):
    return context.overlap_windows(a.m3(spark, sf), 8, 2).select("channel_url", "message_id", "pos", "chunk")


# ---- sorts, limits, top-k


@query("sort_messages", sql("""
SELECT channel_url, message_id, row_number() OVER (ORDER BY channel_url, created_time NULLS FIRST, ingest_seq, message_id) AS place FROM x1""", "x1"))
def sort_messages(spark, sf):
    """The place of each row in the sorted output, told from its partition and place there."""
    rows = m.sort_messages(m.clean_messages(a.x1_raw(spark, sf)))
    placed = rows.select("channel_url", "message_id", "created_time", "ingest_seq", F.monotonically_increasing_id().alias("_at"))
    ordered = blocks.scan(blocks.in_blocks(placed, [], ["_at"]), place=blocks.Step("row_number"))
    return blocks.finish(ordered).select("channel_url", "message_id", "place")


@query("largest_channels", sql("SELECT channel_url, count(*) AS n_messages FROM m2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "m2"))
def largest_channels(spark, sf):
    return channels.largest_channels(channels.channel_counts(a.m2(spark, sf)))


@query("representative_channels", sql(f"""
, counts AS (SELECT channel_url, count(*) AS n FROM m3 GROUP BY 1)
SELECT size_band, channel_url, n AS n_messages FROM (
  SELECT *, row_number() OVER (PARTITION BY size_band ORDER BY n DESC, channel_url) AS rn FROM (SELECT *, {BANDS} AS size_band FROM counts)) WHERE rn = 1""", "m3"))
def representative_channels(spark, sf):
    return channels.representative_channels(channels.channel_counts(a.m3(spark, sf)), by_rank=True)


@query("sorted_cases", sql("""
SELECT case_number, channel_url, start_time, row_number() OVER (ORDER BY channel_url, start_time, case_index) AS place FROM cases""", "cases"))
def sorted_cases(spark, sf):
    rows = stats.sorted_cases(b.segmented(spark, sf).cases)
    placed = rows.select("case_number", "channel_url", "start_time", F.monotonically_increasing_id().alias("_at"))
    ordered = blocks.scan(blocks.in_blocks(placed, [], ["_at"]), place=blocks.Step("row_number"))
    return blocks.finish(ordered).drop("_at")


@query("top_categories", sql(f"""
, ranked AS (SELECT *, row_number() OVER (ORDER BY cases DESC, category) AS rn FROM categories)
SELECT category, replace(replace(category, '_', ' - '), '  ', ' ') AS display, cases, {percent_label('cases', TOTAL)} AS label FROM ranked WHERE rn <= 15
UNION ALL SELECT '', '... and ' || (count(*) - 15) || ' more categories', NULL, '...' FROM ranked HAVING count(*) > 15""", "categories", "classified"))
def top_categories(spark, sf):
    return stats.top_categories(b.classifications(spark, sf))


@query("sorted_classifications", sql("""
SELECT case_number, confidence::DOUBLE AS confidence, row_number() OVER (ORDER BY confidence DESC, case_number) AS place FROM classified""", "classified"))
def sorted_classifications(spark, sf):
    rows = classify.sorted_classifications(b.classifications(spark, sf))
    placed = rows.select("case_number", "confidence", F.monotonically_increasing_id().alias("_at"))
    ordered = blocks.scan(blocks.in_blocks(placed, [], ["_at"]), place=blocks.Step("row_number"))
    return blocks.finish(ordered).drop("_at")


@query("sort_case_messages", sql("""
SELECT case_number, message_id, row_number() OVER (PARTITION BY case_number ORDER BY created_time, ingest_seq, message_id) AS case_pos
FROM labelled WHERE case_number <> ''""", "labelled"))
def sort_case_messages(spark, sf):
    return c.sort_case_messages(b.segmented(spark, sf).messages).select("case_number", "message_id", "case_pos")


@query("sample_rows", sql("""
SELECT channel_url, message_id, created_time, message FROM m1 ORDER BY channel_url, created_time, ingest_seq, message_id LIMIT 10""", "m1"))
def sample_rows(spark, sf):
    return m.sample_rows(a.m1(spark, sf), 10).select("channel_url", "message_id", "created_time", "message")


# ---- set operations


@query("union_channel_cases", sql("""
SELECT channel_url, case_index, piece, start_pos, end_pos FROM split_bounds""", "split_bounds"))
def union_channel_cases(spark, sf):
    cases = b.boundaries(spark, sf)
    pieces = review.apply_splits(cases, review.read_reviews(a.r2_replies(cases, 0)))
    return pieces.select("channel_url", "case_index", "piece", "start_pos", "end_pos")


@query("distinct_cases", sql("SELECT DISTINCT case_number FROM labelled WHERE case_number <> ''", "labelled"))
def distinct_cases(spark, sf):
    return c.distinct_cases(b.segmented(spark, sf).messages)
