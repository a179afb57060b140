"""The driver's tables as chat messages, and model replies derived from them.

M1 from conversations, M2 from events, M3 from orders and line items, X1 from conversations with dirt.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from convocases.operators.messages import clean_messages, load_messages
from convocases.operators.taxonomy import taxonomy_table

CONFIDENCES = "array(0.3D, 0.55D, 0.72D, 0.8D, 0.95D)"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def confidence(shift: int) -> Column:
    return F.expr(f"element_at({CONFIDENCES}, cast(pmod(conv_id + {shift}, 5) as int) + 1)")


def m1_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as raw text rows, as an export would hold them."""
    seconds = "1704067200 + conv_id * 3600 + turn * 600"
    return table(spark, sf, "conversations").selectExpr(
        "'conv_' || conv_id as channel_url",
        "conv_id || '-' || turn as message_id",
        "conv_id * 1000 + turn as ingest_seq",
        f"date_format(timestamp_seconds({seconds}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as created_time",
        "case when role = 'user' then 'u' || conv_id else 'psops' || conv_id % 5 end as sender_id",
        "case role when 'user' then 'user' when 'assistant' then 'customer_service' else '' end as sender_type",
        "'MESG' as type",
        "text as message",
        "'' as real_sender_id",
        "'' as file_url",
    )


def m1(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    """`spread` deals the rows out before they are cleaned: a row group is one task, however long cleaning its texts takes."""
    raw = m1_raw(spark, sf)
    raw = raw.repartition("channel_url", "message_id") if spread else raw
    return load_messages(clean_messages(raw)).drop("created_time_raw")


def m2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "'user_' || user_id as channel_url",
        "cast(event_id as string) as message_id",
        "event_id as ingest_seq",
        "cast(ts as timestamp) as created_time",
        "'u' || user_id as sender_id",
        "'' as sender_type",
        "case when event_type = 'purchase' then 'FILE' else 'MESG' end as type",
        "event_type as message",
    )


def m3(spark: SparkSession, sf: str) -> DataFrame:
    # Dealt by order first, so that telling rows apart and the join need one exchange.
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition("l_orderkey").distinct()
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).selectExpr(
        "'cust_' || o_custkey as channel_url",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as message_id",
        "l_orderkey * 10 + l_linenumber as ingest_seq",
        "cast(o_orderdate as timestamp) + make_interval(0, 0, 0, 0, l_linenumber) as created_time",
        "case when l_linenumber % 2 = 0 then 'psops' || l_suppkey else 'u' || o_custkey end as sender_id",
        "'' as sender_type",
        "'MESG' as type",
        "'About order #' || l_orderkey || ' item ' || l_partkey as message",
    )


def x1_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations with control characters, blanks, bad times, missing ids and curly quotes put in."""
    key = "(conv_id + turn)"
    return table(spark, sf, "conversations").selectExpr(
        f"case when {key} % 13 = 5 then '' else 'conv_' || conv_id end as channel_url",
        f"case when {key} % 11 = 3 then '' else conv_id || '-' || turn end as message_id",
        "conv_id * 1000 + turn as ingest_seq",
        "case pmod(conv_id + 2 * turn, 8)"
        " when 0 then '2024-01-01T10:00:00Z' when 1 then '2024-01-01T10:00:00+09:00'"
        " when 2 then '2024-01-02 11:30:00.250' when 3 then '2024' when 4 then 'junk' when 5 then ''"
        " when 6 then '2024-01-03' else '2024-02-30T10:00:00Z' end as created_time",
        "case when role = 'user' then 'u' || conv_id else 'psops' || conv_id % 5 end as sender_id",
        "case when turn % 2 = 0 then '' else 'robot' end as sender_type",
        f"case when {key} % 3 = 0 then 'FILE' else 'MESG' end as type",
        f"case {key} % 10"
        " when 0 then text when 1 then chr(7) || text || chr(127)"
        " when 2 then '  ' || replace(text, ' ', chr(9) || chr(10)) || chr(13) when 3 then '' when 4 then '   '"
        " when 5 then decode(unhex('EFBFBD'), 'UTF-8') || text when 6 then null"
        " when 7 then decode(unhex('E2809C'), 'UTF-8') || text || decode(unhex('E28099'), 'UTF-8')"
        " when 8 then chr(11) || chr(12) else text || text end as message",
    )


def f8_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("label", "vec_id", "embedding")


def reply_costs(conv: str = "conv_id") -> list[str]:
    return [
        f"100 + {conv} as input_tokens", f"40 + {conv} % 7 as output_tokens", f"'model-' || {conv} % 2 as model",
        f"'provider-' || {conv} % 3 as provider", f"0.5D + ({conv} % 4) * 0.25D as seconds",
    ]


def conv_sizes(messages: DataFrame) -> DataFrame:
    return messages.groupBy("channel_url").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "channel_url", "cast(substring_index(channel_url, '_', -1) as bigint) as conv_id", "n", "(n + 1) div 2 as h"
    )


def r1_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Segmentation replies: two halves per channel in several wrappings, some broken, some absent."""
    rows = conv_sizes(m1(spark, sf)).withColumns({"c1": confidence(0), "c2": confidence(2)})
    rows = rows.where("conv_id % 11 <> 10").withColumn("v", F.expr("conv_id % 7"))
    body = (
        "'{\"complete_cases\":[{\"start_message\":1,\"end_message\":' || h || ',\"summary\":\"First part of ' || channel_url"
        " || '\",\"confidence\":' || c1 || '},{\"start_message\":' || case when v = 3 then h else h + 1 end"
        " || ',\"end_message\":' || case when v = 5 then n + 5 else n end || ',\"summary\":\"\"'"
        " || case when v = 6 then '' else ',\"confidence\":' || c2 end || '}],\"analysis\":\"two parts\"}'"
    )
    rows = rows.withColumn("body", F.expr(body))
    content = (
        "case when conv_id % 13 = 12 then null"
        " when v = 1 then 'Here you are <output>' || body || '</output>'"
        " when v = 2 then 'Sure:\\n```json\\n' || body || '\\n```\\nDone.'"
        " when v = 3 then 'I think ' || body || ' is right.'"
        " when v = 4 then substring(body, 1, length(body) - 5) else body end as content"
    )
    return rows.selectExpr(
        "'segment:' || channel_url || ':0' as request_id", "channel_url", "cast(null as bigint) as case_index", content,
        *reply_costs(), "case when conv_id % 13 = 12 then 'timeout' end as error",
    )


def r2_replies(boundaries: DataFrame, round_no: int) -> DataFrame:
    """Review replies for the given cases: several kinds in round 0, no case flagged later."""
    rows = boundaries.selectExpr(
        "channel_url", "case_index", "cast(substring_index(channel_url, '_', -1) as bigint) as conv_id"
    ).withColumns({"v": F.expr("conv_id % 7"), "c": F.expr(f"element_at({CONFIDENCES}, cast(pmod(conv_id + case_index + 1, 5) as int) + 1)")})
    if round_no > 0:
        rows = rows.withColumn("v", F.lit(0))
    content = (
        "'{\"needs_split\":' || case when v = 0 then 'false' when v = 3 then '\"yes\"' else 'true' end"
        " || ',\"confidence\":' || c || ',\"reasoning\":\"round " + str(round_no) + "\",\"suggested_split_points\":['"
        " || case when v = 1 then '2' when v = 2 then '99,0,-3' when v = 5 then '2,2' when v = 6 then '1' else '' end || ']}' as content"
    )
    return rows.where("v <> 4").selectExpr(
        f"'review:{round_no}:' || channel_url || ':' || case_index || ':0' as request_id",
        "channel_url", "case_index", content, *reply_costs(), "cast(null as string) as error",
    )


def r3_replies(cases: DataFrame) -> DataFrame:
    """Classification replies for the given numbered cases: valid, out of the taxonomy, incomplete, no JSON."""
    spark = cases.sparkSession
    leaves = F.broadcast(taxonomy_table(spark).selectExpr(
        "primary", "secondary", "cast(row_number() over (order by primary_no, leaf_no) - 1 as bigint) as leaf"
    ))
    rows = cases.selectExpr(
        "case_number", "channel_url", "case_index", "cast(substring_index(channel_url, '_', -1) as bigint) as conv_id"
    ).withColumns({"leaf": F.expr("conv_id % 89"), "v": F.expr("(conv_id + case_index) % 7"), "c": confidence(0)})
    rows = rows.join(leaves, "leaf").withColumn("body", F.expr(
        "'{\"primary_category\":\"' || case when v = 1 then 'Weather' else primary end"
        " || '\",\"secondary_category\":\"' || case when v = 2 then 'Rain' else secondary end"
        " || '\",\"confidence\":' || case when v = 3 then '1.7' else cast(c as string) end"
        " || case when v = 4 then '' else ',\"reasoning\":\"because the talk in ' || channel_url || ' is mostly about ' || lower(secondary) || '\"' end || '}'"
    ))
    content = "case v when 5 then 'Well: <output> ' || body || ' </output> so.' when 6 then 'no idea' else body end as content"
    return rows.selectExpr(
        "'classify:' || case_number as request_id", "case_number", "channel_url", content, *reply_costs(),
        "cast(null as string) as error",
    )
