"""Queries: operators with limits of some dozens of rows, so that groups are cut, joins dealt out and numbers dealt in ranges.

They have the SQL of the same operators with their usual limits: results must not depend on where groups are cut.
"""

import time

from pyspark.sql import functions as F

from checks import adapters as a, bases as b, stats_and_order, tables_and_text  # noqa: F401
from checks.ctes import line, sql
from checks.registry import SQL, query
from convocases.operators import blocks, cases as c, channels, context, messages as m, replies as r, segment
from convocases.operators.blocks import Step
from convocases.plans import frontier, pipeline, requests
from convocases.sources.scratch import DENSE, checkpointed

ROWS = 48


@query("message_positions_in_blocks", SQL["message_positions"])
def message_positions(spark, sf):
    feed = a.m3(spark, sf)
    return m.message_positions(feed, m.message_cuts(feed, ROWS)).select("channel_url", "message_id", "pos")


@query("segment_by_rules_in_blocks", SQL["segment_by_rules"])
def segment_by_rules(spark, sf):
    columns = ("channel_url", "message_id", "pos", "rule", "boundary_confidence", "case_index")
    feeds = ((a.m3(spark, sf), b.M3_RULES), (a.m2(spark, sf), b.M2_RULES))
    one, two = (segment.segment_by_rules(feed, m.message_cuts(feed, ROWS), rules).select(*columns) for feed, rules in feeds)
    return one.unionByName(two)


@query("force_boundaries_in_blocks", SQL["force_boundaries"])
def force_boundaries(spark, sf):
    feed = a.m2(spark, sf)
    cuts = m.message_cuts(feed, 4)
    rows = segment.segment_by_rules(feed, cuts, b.M2_RULES)
    cases = c.cases_of_segments(segment.force_boundaries(rows, 3, cuts))
    return cases.select("channel_url", "case_index", "start_pos", "end_pos", "n_messages", "forced_starting", "forced_ending", "confidence")


@query("fit_token_budget_in_blocks", SQL["fit_token_budget"])
def fit_token_budget(spark, sf):
    feed = a.m3(spark, sf)
    kept = context.fit_token_budget(feed, max_context=250, reserve=50, cuts=m.message_cuts(feed, ROWS))
    return kept.select("channel_url", "message_id", "pos", "running_tokens", "case_truncated")


@query("number_cases_in_ranges", SQL["number_cases"])
def number_cases(spark, sf):
    rows = b.m3_rules(spark, sf).cases.drop("case_number")
    return c.number_cases(rows, rows_per_block=ROWS).select("channel_url", "case_index", "case_number")


@query("filter_channels_dealt_out", SQL["filter_channels"])
def filter_channels(spark, sf):
    """Typed messages with a map of their round columns, a selection beyond the broadcast limit, and hot channels."""
    wanted = a.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("'user_' || c_custkey as channel_url")
    typed = a.m2(spark, sf).withColumn("round_columns", F.create_map(F.lit("round 1"), F.col("message")))
    kept = channels.filter_channels(typed, wanted, broadcast_channels=0, hot_rows=2)
    missing = channels.missing_channels(typed, wanted)
    return kept.select(F.lit("kept").alias("part"), "channel_url", "message_id").unionByName(
        missing.select(F.lit("missing").alias("part"), "channel_url", F.lit(None).cast("string").alias("message_id")))


@query("null_channel_in_blocks", sql("""
SELECT channel_url, message_id, row_number() OVER (PARTITION BY channel_url ORDER BY created_time, ingest_seq, message_id) AS pos
FROM (SELECT * REPLACE (CASE WHEN ingest_seq % 3 = 0 THEN NULL ELSE channel_url END AS channel_url) FROM m3)""", "m3"))
def null_channel(spark, sf):
    rows = a.m3(spark, sf).withColumn("channel_url", F.when(F.col("ingest_seq") % 3 != 0, F.col("channel_url")))
    o = blocks.in_blocks(rows, ["channel_url"], m.TIME_ORDER, rows_per_block=ROWS)
    return blocks.finish(blocks.scan(o, pos=Step("row_number"))).select("channel_url", "message_id", "pos")


@query("fallback_over_parts", sql("""
SELECT channel_url, 0::BIGINT AS case_index, 1::BIGINT AS start_pos, count(*) AS end_pos, 0.3::DOUBLE AS confidence FROM m1_pos GROUP BY 1""", "m1_pos"))
def fallback_over_parts(spark, sf):
    """A budget so small that channels have many parts, and no replies: still one case for each channel."""
    asked = requests.segmentation_requests(a.m1(spark, sf), budget=60)
    rows = r.boundaries_of_replies(asked, spark.createDataFrame([], requests.REPLY_SCHEMA))
    return rows.select("channel_url", "case_index", "start_pos", "end_pos", "confidence")


def answers_of(asked, truth):
    """What a model would say that knows the true ranges, but only sees each request's own messages."""
    seen = asked.select("request_id", "channel_url", "first_pos", "last_pos").join(truth.hint("merge"), ["channel_url"])
    seen = seen.where("start_pos <= last_pos and end_pos >= first_pos")
    case = F.format_string(
        '{"start_message": %d, "end_message": %d, "summary": "case from %d", "confidence": 0.75}',
        F.greatest("start_pos", "first_pos"), F.least("end_pos", "last_pos"), F.col("start_pos"))
    listed = F.sort_array(F.collect_list(F.struct("start_pos", case.alias("case"))))
    content = F.concat(F.lit('{"complete_cases": ['), F.array_join(F.transform(listed, lambda c: c["case"]), ", "), F.lit("]}"))
    return seen.groupBy("request_id").agg(content.alias("content")).withColumn("error", F.lit(None).cast("string"))


@query("segment_with_overlapping_parts", sql("""
SELECT channel_url, case_index, start_pos, end_pos, n_messages, false AS forced_ending, false AS forced_starting, 'case from ' || start_pos AS summary FROM m3_cases
UNION ALL SELECT channel_url, k, CASE k WHEN 0 THEN 1 ELSE h + 1 END, CASE k WHEN 0 THEN h ELSE n END, CASE k WHEN 0 THEN h ELSE n - h END, false, false,
  'case from ' || CASE k WHEN 0 THEN 1 ELSE h + 1 END
FROM (SELECT channel_url, count(*) AS n, (count(*) + 1) // 2 AS h FROM m2 GROUP BY channel_url), (VALUES (0), (1)) t(k)""", "m3_cases", "m2"))
def segment_with_overlapping_parts(spark, sf):
    """A budget of 300 tokens, so that requests hold some seven messages: the cases are those of the whole transcript."""
    halves = a.conv_sizes(a.m2(spark, sf)).select("channel_url", F.inline(F.expr(
        "array(struct(1L as start_pos, h as end_pos), struct(h + 1 as start_pos, n as end_pos))")))
    out = []
    for feed, truth in ((b.m3_feed(spark, sf), b.m3_rules(spark, sf).cases.select("channel_url", "start_pos", "end_pos")), (a.m2(spark, sf), halves)):
        asked = checkpointed(requests.segmentation_requests(feed, budget=300, overlap=100), **DENSE)
        cases = pipeline.segment_with_replies(feed, answers_of(asked, truth), requests=asked).cases
        out.append(cases.select(
            "channel_url", "case_index", "start_pos", "end_pos", "n_messages", "forced_ending", "forced_starting", "summary"))
    return out[0].unionByName(out[1])


@query("assign_nested_cases", sql("""
, k AS (SELECT channel_url, n, channel_seq, unnest(range(1, n // 2 + 1)) AS i FROM (SELECT channel_url, max(n) AS n, min(channel_seq) AS channel_seq FROM m2_pos GROUP BY 1)),
numbered AS (SELECT channel_url, i, printf('CASE_%04d', row_number() OVER (ORDER BY channel_seq, channel_url, i)) AS case_number FROM k)
SELECT p.channel_url, p.message_id, coalesce(case_number, '') AS case_number
FROM m2_pos p LEFT JOIN numbered c ON c.channel_url = p.channel_url AND c.i = least(pos, n + 1 - pos, n // 2)""", "m2_pos"))
def assign_nested_cases(spark, sf):
    """Cases of which each lies inside the one before, half as many as messages: the last one that holds a message wins."""
    feed = a.m2(spark, sf)
    positioned = checkpointed(m.message_positions(feed))
    sizes = positioned.groupBy("channel_url").agg(F.count(F.lit(1)).alias("n"), F.min("ingest_seq").alias("channel_seq"))
    ranges = sizes.select("channel_url", "channel_seq", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("n") / 2))).alias("start_pos"))
    nested = ranges.select(
        "channel_url", "channel_seq", (F.col("start_pos") - 1).alias("case_index"), "start_pos", (F.col("n") + 1 - F.col("start_pos")).alias("end_pos"),
        F.lit(None).cast("timestamp").alias("start_time"), F.lit(None).cast("timestamp").alias("end_time"), F.lit(0.0).alias("duration_minutes"),
        F.lit(0.5).alias("confidence"), F.lit("").alias("summary"), F.lit(False).alias("forced_ending"), F.lit(False).alias("forced_starting"))
    done = c.assign_cases(feed, c.number_cases(checkpointed(nested)), positioned)
    return done.select("channel_url", "message_id", "case_number")


@query("truncated_rows", sql(f"""
, t AS (SELECT channel_url, message_id, sum(length({line('pos')}) // 4) OVER (PARTITION BY channel_url ORDER BY pos) AS running FROM m1_pos)
SELECT channel_url, message_id, running <= 200 AS assigned, running <= 200 AND max(running) OVER (PARTITION BY channel_url) > 200 AS case_truncated FROM t""", "m1_pos"))
def truncated_rows(spark, sf):
    """Transcripts cut at 200 tokens: what was left out has no case, and the cases say that something was."""
    asked = requests.segmentation_requests(a.m1(spark, sf), overflow="truncate", budget=200)
    done = pipeline.segment_with_replies(a.m1(spark, sf), spark.createDataFrame([], requests.REPLY_SCHEMA), requests=asked)
    return done.messages.select("channel_url", "message_id", (F.col("case_number") != "").alias("assigned"), "case_truncated")


def brittle(batch):
    """A stand-in for a model that fails as a whole where one request is in the batch."""
    if batch["channel_url"].str.endswith("_7").any():
        raise ValueError("no")
    return batch[["request_id"]].assign(content=batch["prompt"].str.len().astype(str))


@query("map_requests_one_raises", sql("""
SELECT 'segment:' || channel_url || ':0' AS request_id, channel_url LIKE '%\\_7' ESCAPE '\\' AS failed FROM m1_pos GROUP BY channel_url""", "m1_pos"))
def map_requests_one_raises(spark, sf):
    replies = requests.map_requests(b.m1_requests(spark, sf), brittle, concurrency=2)
    return replies.select("request_id", (F.col("error") == "ValueError: no").isNotNull().alias("failed"))


def slow_and_brittle(request):
    """A stand-in for a model that takes some milliseconds for a request and refuses some."""
    time.sleep(0.005)
    if request["channel_url"].endswith("_7"):
        raise ValueError("no")
    return {"content": str(len(request["prompt"])), "input_tokens": request["prompt_tokens"]}


@query("map_requests_in_flight", sql("""
SELECT 'segment:' || channel_url || ':0' AS request_id, channel_url LIKE '%\\_7' ESCAPE '\\' AS failed, channel_url NOT LIKE '%\\_7' ESCAPE '\\' AS answered
FROM m1_pos GROUP BY channel_url""", "m1_pos"))
def map_requests_in_flight(spark, sf):
    """Sixteen calls at once in each of two tasks, at a shared rate: a row for every request, errors where they belong."""
    replies = requests.call_requests(b.m1_requests(spark, sf), slow_and_brittle, tasks=2, in_flight=16, tokens_per_minute=30_000_000)
    return replies.select(
        "request_id", (F.col("error") == "ValueError: no").isNotNull().alias("failed"), (F.col("input_tokens") > 0).isNotNull().alias("answered"))


@query("segment_by_queue", sql("""
SELECT 'rules' AS model, channel_url, case_index, start_pos, end_pos, false AS forced_ending, false AS forced_starting FROM m2_cases
UNION ALL SELECT 'whole', channel_url, k, 20 * k + 1, least(20 * (k + 1), n), 20 * (k + 1) < n, k > 0
FROM (SELECT channel_url, n, unnest(range(0, (n + 19) // 20)) AS k FROM (SELECT channel_url, max(n) AS n FROM m2_pos GROUP BY 1))""", "m2_cases", "m2_pos"))
def segment_by_queue(spark, sf):
    """Windows of 20 messages: a model that knows the rule cases gives just these; one that sees no end is cut at 20."""
    feed, out = a.m2(spark, sf), []
    whole = a.conv_sizes(feed).selectExpr("channel_url", "1L as start_pos", "n as end_pos")
    for model, truth in (("rules", b.m2_rules(spark, sf).cases.select("channel_url", "start_pos", "end_pos")), ("whole", whole)):
        found = frontier.segment_by_queue(feed, lambda asked: answers_of(asked, truth), size=20)  # noqa: B023
        out.append(found.select(F.lit(model).alias("model"), "channel_url", "case_index", "start_pos", "end_pos", "forced_ending", "forced_starting"))
    return out[0].unionByName(out[1])


@query("channel_stats_reviewed", sql("""
, per AS (SELECT channel_url, any_value(v) AS v, count(*) AS reviewed FROM r2 GROUP BY 1),
found AS (SELECT channel_url, count(*) AS k, sum(confidence::DOUBLE) AS cs FROM refined GROUP BY 1)
SELECT channel_url, n AS total_messages, coalesce(k, 0) AS cases_found,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE input_tokens END::BIGINT AS input_tokens,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE output_tokens END::BIGINT AS output_tokens,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE 1 END::BIGINT AS calls,
  CASE WHEN status IN ('missing', 'error') THEN 0 ELSE seconds END::DOUBLE AS seconds,
  round(coalesce(cs, 0), 6) AS confidence_sum, CASE WHEN per.v IN (1, 2, 5, 6) THEN 1 ELSE 0 END::BIGINT AS review_iterations,
  CASE WHEN per.v IN (1, 2, 5, 6) THEN reviewed ELSE 0 END::BIGINT AS cases_reviewed, CASE WHEN per.v IN (1, 2, 5, 6) THEN reviewed ELSE 0 END::BIGINT AS cases_split
FROM r1 LEFT JOIN found USING (channel_url) LEFT JOIN per USING (channel_url)""", "r1", "r2", "refined"))
def channel_stats_reviewed(spark, sf):
    """Statistics of a run with a review: its counters reach every channel."""
    replies = a.r1_replies(spark, sf)
    run = pipeline.run_pipeline(
        a.m1(spark, sf), skip_clean=True, skip_classify=True, segmentation_replies=replies, segmentation_requests=b.m1_requests(spark, sf),
        review=a.r2_replies)
    return pipeline.results(run, replies).channels
