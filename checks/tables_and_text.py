"""Queries: sources and sinks, column functions, filters."""

from pyspark.sql import Window, functions as F

from checks import adapters as a, bases as b
from checks.ctes import band, clean, fixed, line, percent_label, sql
from checks.registry import query
from convocases.functions import text
from convocases.operators import channels, classify, messages as m, reports, taxonomy
from convocases.plans import requests
from convocases.sources import readers, sinks
from convocases.sources.scratch import new_path

SOURCE = {new: old for old, new in m.REQUIRED.items()}
#: Rows that a task sorts and writes to a file of a source in order; fewer where they hold long texts.
ROWS_PER_FILE, TEXTS_PER_FILE = 1_000_000, 200_000

# ---- sources and sinks


@query("scan_messages_csv", sql("""
SELECT channel_url, message_id, sender_id, raw_sender_type AS sender_type, strftime(created_time, '%Y-%m-%dT%H:%M:%SZ') AS created_time,
  text AS message, false AS malformed FROM m1_raw""", "m1_raw"))
def scan_messages_csv(spark, sf):
    path = new_path(spark, "export")
    sinks.write_messages(a.m1_raw(spark, sf).drop("ingest_seq").withColumnsRenamed(SOURCE), path, "csv")
    rows = readers.read_messages(spark, path)
    return rows.select(
        "channel_url", "message_id", "sender_id", "sender_type", "created_time", "message",
        F.col(readers.MALFORMED).isNotNull().alias("malformed"),
    )


def with_splits(spark, size, read):
    """What `read` gives where splits hold so many bytes, the borders of records being found at once."""
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k in settings:
            spark.conf.set(k, size)
        return read()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@query("scan_messages_csv_in_splits", sql("""
SELECT channel_url, message_id, message, row_number() OVER (PARTITION BY channel_url ORDER BY turn) AS nth, false AS malformed FROM (
  SELECT channel_url, message_id, turn, CASE turn % 3 WHEN 0 THEN text || chr(10) || '"' || text || '"' || chr(10) || ',' WHEN 1 THEN '"' || text ELSE text END AS message
  FROM m1_raw)""", "m1_raw"))
def scan_messages_csv_in_splits(spark, sf):
    """Cells with line breaks, commas and quotes in files of many splits of 4 KB: records and their order stay."""
    path = new_path(spark, "export")
    rows = a.m1_raw(spark, sf).withColumn("message", F.expr(
        "case (ingest_seq % 1000) % 3 when 0 then message || '\n\"' || message || '\"\n,' when 1 then '\"' || message else message end"))
    files = max(3, -(-a.table(spark, sf, "conversations").count() // TEXTS_PER_FILE))
    ordered = rows.repartitionByRange(files, "ingest_seq").sortWithinPartitions("ingest_seq").drop("ingest_seq")
    sinks.write_messages(ordered.withColumnsRenamed(SOURCE), path, "csv")
    found = with_splits(spark, "4k", lambda: readers.read_messages(spark, path))
    nth = F.row_number().over(Window.partitionBy("channel_url").orderBy("ingest_seq"))
    return found.select("channel_url", "message_id", "message", nth.cast("long").alias("nth"), F.col(readers.MALFORMED).isNotNull().alias("malformed"))


@query("load_raw_table_numbered", sql("""
SELECT channel_url, message_id, row_number() OVER (PARTITION BY channel_url ORDER BY ingest_seq, message_id) AS nth FROM m3""", "m3"))
def load_raw_table_numbered(spark, sf):
    """A compressed table in ingest order whose numbers are gone: the reader numbers its rows in that order."""
    path = new_path(spark, "raw")
    order = ["channel_url", "ingest_seq", "message_id"]
    files = max(3, -(-a.table(spark, sf, "lineitem").count() // ROWS_PER_FILE))
    a.m3(spark, sf).repartitionByRange(files, *order).sortWithinPartitions(*order).drop("ingest_seq").write.parquet(path)
    nth = F.row_number().over(Window.partitionBy("channel_url").orderBy("ingest_seq"))
    return readers.load_raw_table(spark, path).select("channel_url", "message_id", nth.cast("long").alias("nth"))


@query("load_messages", sql("""
SELECT channel_url, message_id, created_time, message, (ingest_seq % 1000)::VARCHAR AS round_1, type || '!' AS round_note, 2::BIGINT AS rounds
FROM x1 WHERE created_time IS NOT NULL""", "x1"))
def load_messages(spark, sf):
    raw = a.x1_raw(spark, sf).withColumns({"round_1": F.expr("cast(ingest_seq % 1000 as string)"), "round_note": F.expr("type || '!'")})
    loaded = m.load_messages(m.clean_messages(raw))
    return loaded.select(
        "channel_url", "message_id", "created_time", "message", F.col("round_columns")["round_1"].alias("round_1"),
        F.col("round_columns")["round_note"].alias("round_note"), F.size("round_columns").cast("long").alias("rounds"),
    )


@query("load_raw_table", sql("SELECT channel_url, message_id, text AS message, '' AS review FROM m1_raw", "m1_raw"))
def load_raw_table(spark, sf):
    path = new_path(spark, "raw")
    a.m1_raw(spark, sf).withColumnsRenamed(SOURCE).write.parquet(path)
    return readers.load_raw_table(spark, path).select("channel_url", "message_id", "message", "review")


@query("write_messages", sql("""
SELECT channel_url, message_id, created_time, sender_type, message, case_number, case_summary FROM labelled""", "labelled"))
def write_messages(spark, sf):
    path = new_path(spark, "messages")
    sinks.write_messages(b.segmented(spark, sf).messages, path, partition_by=["sender_type"])
    back = spark.read.parquet(path)
    return back.select("channel_url", "message_id", "created_time", "sender_type", "message", "case_number", "case_summary")


WRITE_BACK = """
SELECT m.channel_url, m.message_id, coalesce(nullif(f.case_number, ''), CASE WHEN m.turn % 2 = 0 THEN 'OLD' ELSE '' END) AS case_number,
  coalesce(nullif(f.category, ''), '') AS category, '' AS review, m.text AS message
FROM m1_raw m LEFT JOIN final f USING (message_id)"""


@query("write_back_labels", sql(WRITE_BACK, "m1_raw", "final"))
def write_back_labels(spark, sf):
    original = a.m1_raw(spark, sf).withColumn("case_number", F.expr("case when ingest_seq % 2 = 0 then 'OLD' else '' end"))
    path = new_path(spark, "labelled")
    sinks.write_back_labels(original, b.final(spark, sf), path)
    return spark.read.parquet(path).select("channel_url", "message_id", "case_number", "category", "review", "message")


@query("export_cases_json", sql("""
SELECT c.case_number AS case_id, c.channel_url, c.summary, c.participants, r.pos, r.message_id, r.sender_id, r.message,
  strftime(c.start_time, '%Y-%m-%d %H:%M:%S') AS start_time
FROM cases c JOIN case_rows r USING (channel_url, case_index)""", "cases", "case_rows"))
def export_cases_json(spark, sf):
    path = new_path(spark, "cases")
    sinks.export_cases_json(b.segmented(spark, sf).cases, b.m1_pos(spark, sf), path)
    schema = (
        "case_id string, part int, channel_url string, start_time timestamp, end_time timestamp, summary string, "
        "participants array<string>, messages array<struct<pos: bigint, message_id: string, sender_id: string, message: string>>"
    )
    rows = spark.read.schema(schema).json(path)
    return rows.select(
        "case_id", "channel_url", "summary", F.array_join("participants", ";").alias("participants"),
        F.inline("messages"), F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
    )


@query("export_cases_csv", sql("""
SELECT case_number, channel_url, start_pos::VARCHAR AS start_pos, end_pos::VARCHAR AS end_pos, n_messages::VARCHAR AS n_messages,
  participants, summary, strftime(start_time, '%Y-%m-%dT%H:%M:%S.000000Z') AS start_time FROM cases""", "cases"))
def export_cases_csv(spark, sf):
    path = new_path(spark, "cases")
    sinks.export_cases_csv(b.segmented(spark, sf).cases, path)
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select("case_number", "channel_url", "start_pos", "end_pos", "n_messages", "participants", "summary", "start_time")


SEGMENT_REPORT = f"""
, cnt AS (SELECT count(*) AS total, avg(confidence) AS mean, count(*) FILTER (confidence < 0.5) AS low FROM cases),
bands AS (SELECT {band('confidence')} AS band, count(*) AS k FROM cases GROUP BY 1),
per_channel AS (SELECT channel_url, count(*) AS k, avg(confidence) AS mean, sum(duration_minutes) AS minutes FROM cases GROUP BY 1)
SELECT 'header' AS section, 'all' AS key, unnest(['total_cases', 'total_channels', 'average_confidence']) AS metric,
  unnest([total::VARCHAR, (SELECT count(*) FROM r1)::VARCHAR, {fixed('mean')}]) AS value FROM cnt
UNION ALL SELECT 'confidence', band, unnest(['cases', 'label']), unnest([k::VARCHAR, {percent_label('k', 'total')}]) FROM bands, cnt
UNION ALL SELECT 'review', 'all', unnest(['channels_with_review', 'total_review_iterations', 'total_cases_reviewed', 'total_cases_split', 'split_rate']),
  unnest(['0', '0', '0', '0', '0.0'])
UNION ALL SELECT 'case', case_number, unnest(['channel', 'start_time', 'end_time', 'duration', 'confidence', 'summary']),
  unnest([substring(split_part(channel_url, '_', -1), 1, 15) || '...', strftime(start_time, '%Y-%m-%d %H:%M:%S'), strftime(end_time, '%Y-%m-%d %H:%M:%S'),
    {fixed('duration_minutes', 1)} || 'm', {fixed('confidence')}, CASE WHEN length(summary) > 40 THEN substring(summary, 1, 40) || '...' ELSE summary END]) FROM cases
UNION ALL SELECT 'channel', channel_url, unnest(['cases', 'average_confidence', 'total_duration', 'review_status']),
  unnest([k::VARCHAR, {fixed('mean')}, {fixed('minutes', 1)}, 'none']) FROM per_channel
UNION ALL SELECT 'verdict', 'all', unnest(['quality', 'low_warning']),
  unnest([CASE WHEN mean >= 0.7 THEN 'good' WHEN mean >= 0.5 THEN 'moderate' ELSE 'poor' END, (low > total * 0.3)::VARCHAR]) FROM cnt"""


@query("segmentation_report", sql(SEGMENT_REPORT, "cases", "r1"))
def segmentation_report(spark, sf):
    return reports.segmentation_report(b.segmented(spark, sf).cases, b.channel_stats(spark, sf))


CLASS_REPORT = f"""
, cnt AS (SELECT count(*) AS total, avg(confidence) AS mean, count(*) FILTER (confidence < 0.5) AS low, count(*) FILTER (confidence >= 0.8) AS high FROM classified),
bands AS (SELECT {band('confidence')} AS band, count(*) AS k FROM classified GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY cases DESC, category) AS rn, replace(replace(category, '_', ' - '), '  ', ' ') AS shown FROM categories),
tops AS (SELECT max(cases) AS top FROM primaries)
SELECT 'header' AS section, 'all' AS key, unnest(['total_classified_cases', 'average_confidence']) AS metric, unnest([total::VARCHAR, {fixed('mean')}]) AS value FROM cnt
UNION ALL SELECT 'confidence', band, unnest(['cases', 'label']), unnest([k::VARCHAR, {percent_label('k', 'total')}]) FROM bands, cnt
UNION ALL SELECT 'primary', primary_name, unnest(['cases', 'label']), unnest([cases::VARCHAR, {percent_label('cases', 'total')}]) FROM primaries, cnt
UNION ALL SELECT 'category', shown, unnest(['cases', 'label']), unnest([cases::VARCHAR, {percent_label('cases', 'total')}]) FROM ranked, cnt WHERE rn <= 15
UNION ALL SELECT 'category', '... and ' || (count(*) - 15) || ' more categories', unnest(['cases', 'label']), unnest(['...', '...']) FROM ranked HAVING count(*) > 15
UNION ALL SELECT 'insight', 'all', unnest(['most_common_category', 'most_common_primary', 'unique_categories', 'unique_primaries']),
  unnest([(SELECT shown FROM ranked WHERE rn = 1), (SELECT primary_name FROM primaries ORDER BY cases DESC, primary_name LIMIT 1),
    (SELECT count(*) FROM categories)::VARCHAR, (SELECT count(*) FROM primaries)::VARCHAR])
UNION ALL SELECT 'case', case_number, unnest(['category', 'confidence', 'level', 'reasoning', 'classified_at']),
  unnest([replace(replace(category, '_', ' - '), '  ', ' '), {fixed('confidence')}, CASE WHEN confidence >= 0.8 THEN '🟢' WHEN confidence >= 0.5 THEN '🟡' ELSE '🔴' END,
    CASE WHEN length(reasoning) > 50 THEN substring(reasoning, 1, 50) || '...' ELSE reasoning END, '2024-06-01 12:00:00']) FROM classified
UNION ALL SELECT 'verdict', 'all', unnest(['quality', 'low_warning', 'high_praise']),
  unnest([CASE WHEN round(mean, 3) >= 0.7 THEN 'good' WHEN round(mean, 3) >= 0.5 THEN 'moderate' ELSE 'poor' END, (low > total * 0.3)::VARCHAR, (high > total * 0.7)::VARCHAR]) FROM cnt
UNION ALL SELECT 'recommendation', 'all', unnest(['review_low_confidence', 'check_imbalance', 'improve_model', 'regular_review']),
  unnest([(low > 0)::VARCHAR, (top > total * 0.5)::VARCHAR, (round(mean, 3) < 0.6)::VARCHAR, 'true']) FROM cnt, tops"""


@query("classification_report", sql(CLASS_REPORT, "classified", "categories", "primaries"))
def classification_report(spark, sf):
    return reports.classification_report(b.classifications(spark, sf))


TRANSCRIPT = f"string_agg({line('pos')}, '' ORDER BY pos)"
LOG_LINE = "'Message ' || pos || ': [' || sender_id || '] ' || substring(message, 1, 100) || '...'"


@query("interaction_log", sql(f"""
SELECT 'segment:' || channel_url || ':0' AS request_id, 'segment' AS call_type, channel_url, n_messages,
  CASE WHEN status = 'error' THEN 'error' ELSE 'success' END AS status, input_tokens, output_tokens, model, provider,
  round(seconds::DOUBLE, 6) AS seconds, CASE WHEN status = 'error' THEN 'timeout' END AS error, sample
FROM r1 JOIN (SELECT channel_url, count(*) AS n_messages, string_agg({LOG_LINE}, chr(10) ORDER BY pos) FILTER (pos <= 3) AS sample FROM m1_pos GROUP BY 1) USING (channel_url)
WHERE status <> 'missing'""", "r1", "m1_pos"))
def interaction_log(spark, sf):
    log = sinks.interaction_log(b.m1_requests(spark, sf), a.r1_replies(spark, sf), b.m1_pos(spark, sf))
    path = new_path(spark, "log")
    sinks.write_interaction_log(log, path)
    return spark.read.parquet(path).select(
        "request_id", "call_type", "channel_url", "n_messages", "status", "input_tokens", "output_tokens", "model",
        "provider", "seconds", "error", "sample",
    )


# ---- column functions


@query("clean_message", sql(f"SELECT ingest_seq, {clean('message')} AS cleaned FROM x1_raw", "x1_raw"))
def clean_message(spark, sf):
    return a.x1_raw(spark, sf).select("ingest_seq", text.clean_message(F.col("message")).alias("cleaned"))


@query("normalize_quotes", sql("""
SELECT ingest_seq, replace(replace(replace(replace(message, chr(8220), '"'), chr(8221), '"'), chr(8216), ''''), chr(8217), '''') AS straight
FROM x1_raw""", "x1_raw"))
def normalize_quotes(spark, sf):
    return a.x1_raw(spark, sf).select("ingest_seq", text.straighten_quotes(F.col("message")).alias("straight"))


@query("truncate_message", """
SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 497) || '...' ELSE text END AS short FROM documents""")
def truncate_message(spark, sf):
    return a.table(spark, sf, "documents").select("doc_id", text.truncate_message(F.col("text")).alias("short"))


@query("parse_created_time", sql("SELECT ingest_seq, created_time, created_time IS NULL AS invalid FROM x1_raw", "x1_raw"))
def parse_created_time(spark, sf):
    rows = a.x1_raw(spark, sf).withColumn("created_time", text.parse_created_time(F.col("created_time")))
    return rows.select("ingest_seq", "created_time", F.col("created_time").isNull().alias("invalid"))


@query("derive_sender_type", sql("SELECT ingest_seq, sender_type FROM x1_raw", "x1_raw"))
def derive_sender_type(spark, sf):
    kind = text.derive_sender_type(F.col("sender_type"), F.col("sender_id"))
    return a.x1_raw(spark, sf).select("ingest_seq", kind.alias("sender_type"))


@query("project_required", sql("""
SELECT 'created_time,sender_id,real_sender_id,message,message_id,type,channel_url,file_url,sender_type,ingest_seq' AS column_order,
  channel_url, message_id, '' AS file_url, '' AS real_sender_id, text AS message, ingest_seq FROM m1_raw""", "m1_raw"))
def project_required(spark, sf):
    rows = m.project_required(a.m1_raw(spark, sf).drop("file_url"))
    kept = ("channel_url", "message_id", "file_url", "real_sender_id", "message", "ingest_seq")
    return rows.select(F.lit(",".join(rows.columns)).alias("column_order"), *kept)


@query("collect_round_columns", sql("""
SELECT message_id, unnest(['round_1', 'round_2']) AS round_name, unnest([turn::VARCHAR, sender_id]) AS round_value FROM m1_raw""", "m1_raw"))
def collect_round_columns(spark, sf):
    rows = a.m1_raw(spark, sf).withColumns({"round_1": F.expr("cast(ingest_seq % 1000 as int)"), "round_2": F.col("sender_id")})
    return rows.select("message_id", F.explode(m.collect_round_columns(rows)).alias("round_name", "round_value"))


@query("approx_tokens", sql("SELECT message_id, length(text) // 4 AS tokens FROM m1_raw", "m1_raw"))
def approx_tokens(spark, sf):
    return a.m1_raw(spark, sf).select("message_id", text.approx_tokens(F.col("message")).alias("tokens"))


@query("format_transcript", sql(f"""
SELECT channel_url, 0 AS part, count(*) AS n_messages, 1::BIGINT AS first_pos, max(pos) AS last_pos, {TRANSCRIPT} AS transcript
FROM m1_pos GROUP BY 1""", "m1_pos"))
def format_transcript(spark, sf):
    rows = requests.format_transcript(a.m1(spark, sf))
    return rows.select("channel_url", "part", "n_messages", "first_pos", "last_pos", "transcript")


EXCERPT = """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY created_time, ingest_seq, message_id) AS case_pos,
  count(*) OVER (PARTITION BY case_number) AS k FROM m3_labelled)
SELECT case_number, string_agg('**Message ' || case_pos || '** [' || sender_type || '] (' || sender_id || ') (' || strftime(created_time, '%Y-%m-%d %H:%M:%S') || '): ' || message,
  chr(10) || chr(10) ORDER BY case_pos) FILTER (case_pos <= 4) || CASE WHEN max(k) > 4 THEN chr(10) || chr(10) || '... and ' || (max(k) - 4) || ' more messages' ELSE '' END AS excerpt
FROM ranked GROUP BY 1"""


@query("format_case_excerpt", sql(EXCERPT, "m3_labelled"))
def format_case_excerpt(spark, sf):
    return classify.format_case_excerpt(b.m3_rules(spark, sf).messages, 4)


@query("format_taxonomy", sql("""
, used AS (SELECT DISTINCT leaf, t.prim, t.sec FROM taxonomy t JOIN r3 USING (prim, sec) WHERE v IN (0, 3, 5)),
blocks AS (SELECT min(t.leaf) AS no, '**' || prim || ':**' || chr(10) || any_value(names) || chr(10) AS block FROM taxonomy t
  JOIN (SELECT prim, string_agg('  - ' || sec, chr(10) ORDER BY leaf) AS names FROM used GROUP BY 1) USING (prim) GROUP BY prim)
SELECT string_agg(block, chr(10) ORDER BY no) AS taxonomy_text FROM blocks""", "taxonomy", "r3"))
def format_taxonomy(spark, sf):
    """The categories that occur in the classifications, in taxonomy order."""
    used = b.classifications(spark, sf).select("category").distinct()
    names = taxonomy.taxonomy_table(spark)
    names = names.withColumn("category", text.combine_category(F.col("primary"), F.col("secondary")))
    return taxonomy.format_taxonomy(names.join(used, ["category"], "left_semi"))


@query("combine_category", sql("""
SELECT case_number, prim || '_' || replace(replace(sec, ' - ', '_'), ' ', '_') AS category FROM r3""", "r3"))
def combine_category(spark, sf):
    rows = a.r3_replies(b.segmented(spark, sf).cases)
    leaves = taxonomy.taxonomy_table(spark).selectExpr(
        "primary", "secondary", "cast(row_number() over (order by primary_no, leaf_no) - 1 as bigint) as leaf")
    conv = F.expr("cast(substring_index(channel_url, '_', -1) as bigint) % 89").alias("leaf")
    rows = rows.select("case_number", conv).join(F.broadcast(leaves), ["leaf"])
    return rows.select("case_number", text.combine_category(F.col("primary"), F.col("secondary")).alias("category"))


@query("primary_of_category", sql("SELECT case_number, split_part(category, '_', 1) AS primary_name FROM classified", "classified"))
def primary_of_category(spark, sf):
    return b.classifications(spark, sf).select("case_number", text.primary_of_category(F.col("category")).alias("primary_name"))


@query("display_category", sql("SELECT case_number, replace(replace(category, '_', ' - '), '  ', ' ') AS shown FROM classified", "classified"))
def display_category(spark, sf):
    return b.classifications(spark, sf).select("case_number", text.display_category(F.col("category")).alias("shown"))


@query("clamp_confidence", "SELECT event_id, round(greatest(0.0, least(1.0, value / 50 - 0.5)), 6) AS clamped FROM events")
def clamp_confidence(spark, sf):
    score = F.expr("cast(value / 50 - 0.5 as string)")
    return a.table(spark, sf, "events").select("event_id", text.clamp_confidence(score).alias("clamped"))


@query("confidence_band", sql(f"""
SELECT case_number, {band('confidence')} AS band, CASE WHEN confidence >= 0.8 THEN '🟢' WHEN confidence >= 0.5 THEN '🟡' ELSE '🔴' END AS symbol
FROM cases""", "cases"))
def confidence_band(spark, sf):
    score = F.col("confidence")
    return b.segmented(spark, sf).cases.select(
        "case_number", text.confidence_band(score).alias("band"), text.band_symbol(score).alias("symbol"))


@query("case_id_format", "SELECT o_orderkey, printf('CASE_%04d', o_orderkey) AS case_number FROM orders")
def case_id_format(spark, sf):
    return a.table(spark, sf, "orders").select("o_orderkey", text.case_id(F.col("o_orderkey")).alias("case_number"))


@query("case_duration", sql("SELECT case_number, round(duration_minutes * 60, 6) AS seconds FROM m2_cases", "m2_cases"))
def case_duration(spark, sf):
    minutes = text.minutes_between(F.col("start_time"), F.col("end_time"))
    return b.m2_rules(spark, sf).cases.select("case_number", (minutes * 60).alias("seconds"))


@query("short_labels", sql("""
SELECT c.case_number, substring(split_part(channel_url, '_', -1), 1, 15) || '...' AS channel_15, substring(split_part(channel_url, '_', -1), 1, 20) || '...' AS channel_20,
  CASE WHEN length(summary) > 40 THEN substring(summary, 1, 40) || '...' ELSE summary END AS summary_40,
  CASE WHEN length(r.reasoning) > 50 THEN substring(r.reasoning, 1, 50) || '...' ELSE r.reasoning END AS reasoning_50
FROM cases c LEFT JOIN classified r USING (case_number, channel_url)""", "cases", "classified"))
def short_labels(spark, sf):
    rows = b.segmented(spark, sf).cases.join(b.classifications(spark, sf).select("case_number", "reasoning"), ["case_number"], "left")
    return rows.select(
        "case_number", text.channel_label(F.col("channel_url")).alias("channel_15"),
        text.channel_label(F.col("channel_url"), 20).alias("channel_20"),
        text.short_label(F.col("summary"), 40).alias("summary_40"),
        text.short_label(F.col("reasoning"), 50).alias("reasoning_50"),
    )


@query("percent_label", sql(f"""
SELECT primary_name, {percent_label('cases', '(SELECT count(*) FROM classified)')} AS label, '0 (0.0%)' AS of_nothing FROM primaries""", "primaries", "classified"))
def percent_label_(spark, sf):
    from convocases.operators import stats
    rows = stats.primary_distribution(b.classifications(spark, sf))
    nothing = text.percent_label(F.lit(0), F.lit(0))
    return rows.select(F.col("primary").alias("primary_name"), "label", nothing.alias("of_nothing"))


# ---- filters


@query("require_ids", sql("SELECT ingest_seq, message_id, channel_url FROM x1_raw WHERE message_id <> '' AND channel_url <> ''", "x1_raw"))
def require_ids(spark, sf):
    return m.require_ids(a.x1_raw(spark, sf)).select("ingest_seq", "message_id", "channel_url")


@query("filter_channels", sql("""
SELECT 'kept' AS part, channel_url, message_id FROM m2 WHERE channel_url IN (SELECT 'user_' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'missing', 'user_' || c_custkey, NULL FROM customer
WHERE c_mktsegment = 'BUILDING' AND 'user_' || c_custkey NOT IN (SELECT channel_url FROM m2)""", "m2"))
def filter_channels(spark, sf):
    wanted = a.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("'user_' || c_custkey as channel_url")
    messages = a.m2(spark, sf)
    kept = channels.filter_channels(messages, wanted).select(F.lit("kept").alias("part"), "channel_url", "message_id")
    missing = channels.missing_channels(messages, wanted)
    return kept.unionByName(missing.select(F.lit("missing").alias("part"), "channel_url", F.lit(None).cast("string").alias("message_id")))


@query("drop_untimed", sql("SELECT ingest_seq, created_time FROM x1 WHERE created_time IS NOT NULL", "x1"))
def drop_untimed(spark, sf):
    return m.drop_untimed(m.clean_messages(a.x1_raw(spark, sf))).select("ingest_seq", "created_time")


@query("assigned_only", sql("SELECT message_id, case_number, category FROM final WHERE case_number <> '' AND category <> ''", "final"))
def assigned_only(spark, sf):
    from convocases.operators.cases import assigned_only as only
    return only(only(b.final(spark, sf)), "category").select("message_id", "case_number", "category")


@query("valid_ranges", sql("""
SELECT channel_url, case_index, start_pos, end_pos,
  CASE WHEN NOT (1 <= start_pos AND start_pos <= end_pos AND end_pos <= n) THEN 'out_of_range' END AS reject_reason FROM proposed""", "proposed"))
def valid_ranges(spark, sf):
    from convocases.operators import replies as r
    rows = r.boundaries_of_replies(b.m1_requests(spark, sf), a.r1_replies(spark, sf))
    columns = ("channel_url", "case_index", "start_pos", "end_pos")
    kept = r.valid_ranges(rows).select(*columns, F.lit(None).cast("string").alias("reject_reason"))
    return kept.unionByName(r.rejected_ranges(rows).select(*columns, "reject_reason"))


@query("drop_types", sql("SELECT channel_url, message_id, type FROM m2 WHERE type <> 'FILE'", "m2"))
def drop_types(spark, sf):
    return m.drop_types(a.m2(spark, sf)).select("channel_url", "message_id", "type")
