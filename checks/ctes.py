"""Shared SQL of the DuckDB side. `sql(final, *names)` puts the named tables, and what they need, before `final`."""

from convocases.operators.taxonomy import TAXONOMY

CONFIDENCES = "[0.3::DOUBLE, 0.55::DOUBLE, 0.72::DOUBLE, 0.8::DOUBLE, 0.95::DOUBLE]"
ORDER = "created_time, ingest_seq, message_id"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def confidence(index: str) -> str:
    return f"{CONFIDENCES}[(({index}) % 5) + 1]"


def clean(x: str) -> str:
    kept = rf"replace(regexp_replace({x}, '{CONTROL}', '', 'g'), chr(65533), '')"
    tidy = rf"trim(regexp_replace({kept}, '\s+', ' ', 'g'))"
    return f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN {tidy} = '' THEN '[empty message]' ELSE {tidy} END"


TABLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def define(name: str, body: str, *needs: str) -> None:
    TABLES[name] = (body, needs)


def sql(final: str, *names: str) -> str:
    ordered: list[str] = []

    def add(name):
        for need in TABLES[name][1]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][0]})" for n in ordered) + "\n" + final


define("m1_raw", """
SELECT conv_id, turn, 'conv_' || conv_id AS channel_url, conv_id || '-' || turn AS message_id,
  conv_id * 1000 + turn AS ingest_seq,
  make_timestamp((1704067200 + conv_id * 3600 + turn * 600) * 1000000) AS created_time,
  CASE WHEN role = 'user' THEN 'u' || conv_id ELSE 'psops' || (conv_id % 5) END AS sender_id,
  CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'customer_service' ELSE '' END AS raw_sender_type,
  CASE role WHEN 'user' THEN 'user' ELSE 'customer_service' END AS sender_type,
  'MESG' AS type, text
FROM conversations""")
define("m1", f"SELECT * EXCLUDE (text), {clean('text')} AS message FROM m1_raw", "m1_raw")
define("m2", """
SELECT 'user_' || user_id AS channel_url, event_id::VARCHAR AS message_id, event_id AS ingest_seq,
  ts::TIMESTAMP AS created_time, 'u' || user_id AS sender_id, '' AS sender_type,
  CASE WHEN event_type = 'purchase' THEN 'FILE' ELSE 'MESG' END AS type, event_type AS message
FROM events""")
define("m3", """
SELECT 'cust_' || o_custkey AS channel_url,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS message_id,
  l_orderkey * 10 + l_linenumber AS ingest_seq, o_orderdate::TIMESTAMP + to_hours(l_linenumber) AS created_time,
  CASE WHEN l_linenumber % 2 = 0 THEN 'psops' || l_suppkey ELSE 'u' || o_custkey END AS sender_id,
  '' AS sender_type, 'MESG' AS type, 'About order #' || l_orderkey || ' item ' || l_partkey AS message
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey""")
define("x1_raw", """
SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 13 = 5 THEN '' ELSE 'conv_' || conv_id END AS channel_url,
  CASE WHEN (conv_id + turn) % 11 = 3 THEN '' ELSE conv_id || '-' || turn END AS message_id,
  conv_id * 1000 + turn AS ingest_seq,
  CASE (conv_id + 2 * turn) % 8 WHEN 0 THEN TIMESTAMP '2024-01-01 10:00:00' WHEN 1 THEN TIMESTAMP '2024-01-01 01:00:00'
    WHEN 2 THEN TIMESTAMP '2024-01-02 11:30:00.250' WHEN 6 THEN TIMESTAMP '2024-01-03 00:00:00' END AS created_time,
  CASE WHEN role = 'user' THEN 'u' || conv_id ELSE 'psops' || (conv_id % 5) END AS sender_id,
  CASE WHEN turn % 2 = 1 THEN 'robot' WHEN role = 'user' THEN 'user' ELSE 'customer_service' END AS sender_type,
  CASE WHEN (conv_id + turn) % 3 = 0 THEN 'FILE' ELSE 'MESG' END AS type,
  CASE (conv_id + turn) % 10 WHEN 0 THEN text WHEN 1 THEN chr(7) || text || chr(127)
    WHEN 2 THEN '  ' || replace(text, ' ', chr(9) || chr(10)) || chr(13) WHEN 3 THEN '' WHEN 4 THEN '   '
    WHEN 5 THEN chr(65533) || text WHEN 6 THEN NULL WHEN 7 THEN chr(8220) || text || chr(8217)
    WHEN 8 THEN chr(11) || chr(12) ELSE text || text END AS message
FROM conversations""")
define("x1", f"SELECT * REPLACE ({clean('message')} AS message) FROM x1_raw WHERE message_id <> '' AND channel_url <> ''", "x1_raw")

for m in ("m1", "m2", "m3"):
    define(f"{m}_pos", f"""
SELECT *, row_number() OVER (PARTITION BY channel_url ORDER BY {ORDER}) AS pos,
  count(*) OVER (PARTITION BY channel_url) AS n, min(ingest_seq) OVER (PARTITION BY channel_url) AS channel_seq
FROM {m}""", m)


def rule_tables(prefix: str, source: str, ref: str, cue: str, session_us: int = 4 * 3600 * 10**6, tag: str = "") -> None:
    """Rule segmentation over a position table: rows `<prefix>_seg<tag>`, numbered cases `<prefix>_cases<tag>`."""
    a, b, seg, cases = (f"{prefix}_{x}{tag}" for x in ("gap", "rule", "seg", "cases"))
    define(a, f"""
SELECT *, lag(created_time) OVER w AS pt, {ref} AS ref,
  last_value({ref} IGNORE NULLS) OVER (PARTITION BY channel_url ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pref
FROM {source} WINDOW w AS (PARTITION BY channel_url ORDER BY {ORDER})""", source)
    define(b, f"""
SELECT *, CASE WHEN pt IS NULL THEN 1 WHEN coalesce(ref <> pref, false) THEN 2
  WHEN gap > 86400000000 AND NOT same THEN 3
  WHEN gap > {session_us} AND gap <= 86400000000 AND NOT same AND (cue OR created_time::DATE <> pt::DATE) THEN 4
  WHEN gap <= {session_us} AND cue AND NOT same THEN 5 END AS rule
FROM (SELECT *, epoch_us(created_time) - epoch_us(pt) AS gap, coalesce(ref = pref, false) AS same, {cue} AS cue FROM {a})""", a)
    define(seg, f"""
SELECT *, (sum(CASE WHEN rule IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY channel_url ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS case_index,
  CASE rule WHEN 1 THEN 0.9 WHEN 2 THEN 0.9 WHEN 3 THEN 0.8 WHEN 4 THEN 0.6 WHEN 5 THEN 0.5 END::DOUBLE AS boundary_confidence
FROM {b}""", b)
    define(cases, f"""
SELECT *, printf('CASE_%04d', row_number() OVER (ORDER BY channel_seq, channel_url, case_index)) AS case_number FROM (
  SELECT channel_url, case_index, min(channel_seq) AS channel_seq, min(pos) AS start_pos, max(pos) AS end_pos,
    min(created_time) AS start_time, max(created_time) AS end_time, count(*) AS n_messages,
    (epoch_us(max(created_time)) - epoch_us(min(created_time))) / 6e7 AS duration_minutes,
    string_agg(DISTINCT sender_id, ';' ORDER BY sender_id) AS participants, max(boundary_confidence) AS confidence,
    'Support case with ' || count(*) || ' messages' AS summary
  FROM {seg} GROUP BY channel_url, case_index)""", seg)


M3_REF = r"nullif(regexp_extract(message, 'order #(\d+)', 1), '')"
rule_tables("m2", "m2_pos", "NULL::VARCHAR", "message = 'signup'")
rule_tables("m2", "m2_pos", "NULL::VARCHAR", "message = 'signup'", 2 * 3600 * 10**6, "_short")
rule_tables("m3", "m3_pos", M3_REF, "false")
rule_tables("m1", "m1_pos", "NULL::VARCHAR", "regexp_matches(message, '^[A-D]')")

define("m3_labelled", """
SELECT s.*, c.case_number, c.start_time AS case_start_time, c.end_time AS case_end_time, c.duration_minutes AS case_duration_minutes,
  c.confidence AS case_confidence, c.summary AS case_summary
FROM m3_seg s JOIN m3_cases c USING (channel_url, case_index)""", "m3_seg", "m3_cases")

# Replies R1: two halves per channel, some broken, some absent.
define("r1", f"""
SELECT *, (n + 1) // 2 AS h, conv_id % 7 AS v,
  CASE WHEN conv_id % 11 = 10 THEN 'missing' WHEN conv_id % 13 = 12 THEN 'error' WHEN conv_id % 7 IN (4, 6) THEN 'invalid' ELSE 'ok' END AS status,
  {confidence('conv_id')} AS c1, {confidence('conv_id + 2')} AS c2,
  100 + conv_id AS input_tokens, 40 + conv_id % 7 AS output_tokens, 'model-' || conv_id % 2 AS model,
  'provider-' || conv_id % 3 AS provider, 0.5 + (conv_id % 4) * 0.25 AS seconds
FROM (SELECT channel_url, conv_id, count(*) AS n, min(ingest_seq) AS channel_seq FROM m1 GROUP BY ALL)""", "m1")
define("proposed", """
SELECT channel_url, conv_id, n, channel_seq, 0::BIGINT AS case_index, 1::BIGINT AS start_pos, h AS end_pos,
  'First part of ' || channel_url AS summary, c1 AS confidence FROM r1 WHERE status = 'ok'
UNION ALL SELECT channel_url, conv_id, n, channel_seq, 1, CASE WHEN v = 3 THEN h ELSE h + 1 END, CASE WHEN v = 5 THEN n + 5 ELSE n END,
  '', c2 FROM r1 WHERE status = 'ok'
UNION ALL SELECT channel_url, conv_id, n, channel_seq, 0, 1, n,
  CASE WHEN status = 'missing' THEN 'No LLM analysis available - processed as single case' ELSE 'LLM analysis failed - processed as single case' END,
  CASE WHEN status = 'missing' THEN 0.3 ELSE 0.1 END FROM r1 WHERE status <> 'ok'""", "r1")
define("bounds", "SELECT * FROM proposed WHERE 1 <= start_pos AND start_pos <= end_pos AND end_pos <= n", "proposed")


def case_tables(bounds: str, rows: str, cases: str) -> None:
    define(rows, f"""
SELECT b.channel_url, b.conv_id, b.case_index, b.start_pos, b.end_pos, b.summary AS given_summary, b.confidence, b.channel_seq,
  p.message_id, p.ingest_seq, p.pos, p.created_time, p.sender_id, p.sender_type, p.message, p.type
FROM {bounds} b JOIN m1_pos p ON b.channel_url = p.channel_url AND p.pos BETWEEN b.start_pos AND b.end_pos""", bounds, "m1_pos")
    define(cases, f"""
SELECT *, printf('CASE_%04d', row_number() OVER (ORDER BY channel_seq, channel_url, case_index)) AS case_number FROM (
  SELECT channel_url, conv_id, case_index, channel_seq, start_pos, end_pos, confidence, min(created_time) AS start_time,
    max(created_time) AS end_time, count(*) AS n_messages,
    (epoch_us(max(created_time)) - epoch_us(min(created_time))) / 6e7 AS duration_minutes,
    string_agg(DISTINCT sender_id, ';' ORDER BY sender_id) AS participants,
    CASE WHEN given_summary = '' THEN 'Support case with ' || count(*) || ' messages' ELSE given_summary END AS summary
  FROM {rows} GROUP BY channel_url, conv_id, case_index, channel_seq, start_pos, end_pos, confidence, given_summary)""", rows)


case_tables("bounds", "case_rows", "cases")
define("labelled", """
SELECT p.*, coalesce(l.case_number, '') AS case_number, l.start_time AS case_start_time, l.end_time AS case_end_time,
  coalesce(l.duration_minutes, 0.0) AS case_duration_minutes, coalesce(l.confidence, 0.0) AS case_confidence,
  coalesce(l.summary, '') AS case_summary, l.case_index
FROM m1_pos p LEFT JOIN (
  SELECT r.channel_url, r.message_id, c.case_number, c.start_time, c.end_time, c.duration_minutes, c.confidence, c.summary, c.case_index,
    row_number() OVER (PARTITION BY r.channel_url, r.message_id ORDER BY r.case_index DESC) AS rn
  FROM case_rows r JOIN cases c USING (channel_url, case_index)) l
ON p.channel_url = l.channel_url AND p.message_id = l.message_id AND l.rn = 1""", "m1_pos", "case_rows", "cases")

# Replies R2: reviews of the cases in `bounds`.
define("r2", f"""
SELECT *, conv_id % 7 AS v, {confidence('conv_id + case_index + 1')} AS rc, end_pos - start_pos + 1 AS len FROM bounds""", "bounds")
define("split_bounds", """
SELECT channel_url, conv_id, n, channel_seq, case_index, piece, start_pos, end_pos,
  CASE WHEN split THEN 'Reviewed case split ' || (piece + 1) || ' from original case ' || case_index || ': ' || substring(summary, 1, 60) || '...' ELSE summary END AS summary,
  CASE WHEN split THEN least(confidence, rc) ELSE confidence END AS confidence
FROM (
  SELECT *, v IN (1, 5) AND len >= 2 OR v = 6 AS split, 0 AS piece, start_pos AS s, CASE WHEN v IN (1, 5) AND len >= 2 THEN start_pos ELSE end_pos END AS e FROM r2
  UNION ALL SELECT *, true, 1, start_pos + 1, end_pos FROM r2 WHERE v IN (1, 5) AND len >= 2)
  t(channel_url, conv_id, n, channel_seq, case_index, s0, e0, summary, confidence, v, rc, len, split, piece, start_pos, end_pos)""", "r2")
define("refined", """
SELECT * EXCLUDE (case_index, piece), (row_number() OVER (PARTITION BY channel_url ORDER BY case_index, piece) - 1)::BIGINT AS case_index FROM split_bounds""", "split_bounds")

# Replies R3: one classification per case.
leaves = [(p, s) for p, ss in TAXONOMY.items() for s in ss]
define("taxonomy", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{p}', '{s}')" for i, (p, s) in enumerate(leaves)) + ") t(leaf, prim, sec)")
define("r3", f"""
SELECT c.case_number, c.channel_url, c.conv_id, (c.conv_id + c.case_index) % 7 AS v, {confidence('c.conv_id')} AS c, t.prim, t.sec,
  'because the talk in ' || c.channel_url || ' is mostly about ' || lower(t.sec) AS reasoning
FROM cases c JOIN taxonomy t ON t.leaf = c.conv_id % 89""", "cases", "taxonomy")
define("classified", """
SELECT case_number, channel_url, prim || '_' || replace(replace(sec, ' - ', '_'), ' ', '_') AS category,
  CASE WHEN v = 3 THEN 1.0 ELSE c END AS confidence, reasoning, TIMESTAMP '2024-06-01 12:00:00' AS classified_at
FROM r3 WHERE v IN (0, 3, 5)""", "r3")
define("final", """
SELECT l.*, coalesce(k.category, '') AS category, coalesce(k.confidence, 0.0) AS classification_confidence,
  coalesce(k.reasoning, '') AS classification_reasoning, k.classified_at
FROM labelled l LEFT JOIN classified k USING (case_number)""", "labelled", "classified")
define("primaries", """
SELECT split_part(category, '_', 1) AS primary_name, count(*) AS cases FROM classified GROUP BY 1""", "classified")
define("categories", "SELECT category, count(*) AS cases FROM classified GROUP BY 1", "classified")


def band(x: str) -> str:
    return f"CASE WHEN {x} >= 0.8 THEN 'high' WHEN {x} >= 0.5 THEN 'medium' ELSE 'low' END"


def percent_label(part: str, whole: str) -> str:
    return f"printf('%d (%.1f%%)', {part}, round_even({part} * 100.0::DOUBLE / {whole}, 1))"


def fixed(x: str, places: int = 3) -> str:
    return f"printf('%.{places}f', round_even({x}, {places}))"


def line(number: str) -> str:
    return (
        f"""'<message id="' || {number} || '">' || chr(10) || '<sender>' || sender_id || '</sender>' || chr(10)"""
        " || '<sender_type>' || sender_type || '</sender_type>' || chr(10)"
        " || '<time>' || strftime(created_time, '%Y-%m-%d %H:%M:%S') || '</time>' || chr(10)"
        " || '<content>' || message || '</content>' || chr(10) || '</message>' || chr(10) || chr(10)"
    )


def text(value: str) -> str:
    """A Python text as SQL."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in value.split("\n"))
