"""Cleaning, times, labels: the edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapters, bases
from convocases.functions import text
from convocases.operators import messages as m


def one(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_message(spark):
    given = {
        None: "", "": "", "   ": "[empty message]", "\x07\x0b": "[empty message]", "�": "[empty message]",
        "a\x00b\x7fc\x1f": "abc", "a\t\n\r b": "a b", " x ": "x", "a  　b": "a b",
        "“hi” ‘you’": "“hi” ‘you’", "a�b": "ab", "line\nbreak": "line break",
    }
    assert one(spark, text.clean_message, list(given)) == list(given.values())


def test_quotes_and_length(spark):
    assert one(spark, lambda c: text.clean_message(c, straighten=True), ["“hi” ‘you’"]) == ["\"hi\" 'you'"]
    short, long = "x" * 500, "x" * 501
    assert one(spark, text.truncate_message, [short, long, None]) == [short, "x" * 497 + "...", None]
    assert one(spark, lambda c: text.clean_message(c, limit=500), [long]) == ["x" * 497 + "..."]


def test_created_time(spark):
    ten = dt.datetime(2024, 1, 1, 10)
    given = {
        "2024-01-01T10:00:00Z": ten, "2024-01-01T10:00:00+00:00": ten, "2024-01-01T19:00:00+09:00": ten,
        "2024-01-01T19:00:00+0900": ten, "2024-01-01 10:00:00": ten, "2024-01-01T10:00": ten, "2024-01-01T10": ten,
        "2024-01-01T10:00:00.500Z": ten.replace(microsecond=500_000), "2024-01-01": dt.datetime(2024, 1, 1),
        "2024": None, "2024-1-1": None, "10:00": None, "junk": None, "": None, None: None, "2024-02-30": None,
        "2024-01-01T25:00:00": None, " 2024-01-01": None,
    }
    assert one(spark, text.parse_created_time, list(given)) == list(given.values())


def test_labels(spark):
    assert one(spark, text.case_id, [1, 9999, 10000], "long") == ["CASE_0001", "CASE_9999", "CASE_10000"]
    assert one(spark, text.clamp_confidence, ["0.5", "1.7", "-2", "x", None]) == [0.5, 1.0, 0.0, None, None]
    assert one(spark, text.confidence_band, [0.8, 0.79, 0.5, 0.49], "double") == ["high", "medium", "medium", "low"]
    assert one(spark, text.approx_tokens, ["", "abc", "abcd", None], "string") == [0, 0, 1, 0]
    assert one(spark, text.display_category, ["Tax and Fee_Sales_Tax"]) == ["Tax and Fee - Sales - Tax"]
    assert one(spark, lambda c: text.percent_label(c, F.lit(8)), [1, 3], "long") == ["1 (12.5%)", "3 (37.5%)"]
    assert one(spark, lambda c: text.percent_label(c, F.lit(0)), [0], "long") == ["0 (0.0%)"]
    assert one(spark, text.channel_label, ["a_b_0123456789abcdefghij", "plain"]) == ["0123456789abcde...", "plain..."]


def test_combine_category(spark):
    df = spark.createDataFrame([("Tax and Fee", "Form 1099"), ("Order", "Refund - Full"), ("Other", "Other")], "p string, s string")
    out = df.select(text.combine_category(F.col("p"), F.col("s")).alias("c")).collect()
    assert [r.c for r in out] == ["Tax and Fee_Form_1099", "Order_Refund_Full", "Other_Other"]
    assert one(spark, text.primary_of_category, ["Tax and Fee_Form_1099"]) == ["Tax and Fee"]


def test_sender_type(spark):
    df = spark.createDataFrame([("", "psops1"), ("", "u1"), ("robot", "psops1"), (None, None)], "t string, i string")
    out = df.select(text.derive_sender_type(F.col("t"), F.col("i")).alias("o")).collect()
    assert [r.o for r in out] == ["customer_service", "user", "robot", "user"]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [r.o for r in df.select(text.cosine(F.col("a"), F.col("b")).alias("o")).collect()] == [1.0, 0.0, None]


RAW = "channel_url string, message_id string, ingest_seq long, created_time string, sender_id string, sender_type string, type string, message string"


def test_bad_time_stays_but_takes_no_position(spark):
    raw = spark.createDataFrame([
        ("c", "1", 0, "junk", "u", "", "MESG", "a"), ("c", "2", 1, "2024-01-01T10:00:00Z", "u", "", "FILE", "b"),
        ("", "3", 2, "2024-01-01T10:00:00Z", "u", "", "MESG", "c"), ("c", "", 3, "2024-01-01T10:00:00Z", "u", "", "MESG", "d"),
    ], RAW)
    clean = m.clean_messages(raw)
    assert {(r.message_id, r.created_time is None) for r in clean.collect()} == {("1", True), ("2", False)}
    assert [(r.message_id, r.pos) for r in m.message_positions(clean).collect()] == [("2", 1)]
    assert m.clean_messages(raw, drop=("FILE",)).count() == 1
    assert [r.message_id for r in m.sort_messages(clean).collect()] == ["1", "2"]


def test_required_columns_come_first(spark):
    df = spark.createDataFrame([("x", "c", "m")], "extra string, channel_url string, message string")
    out = m.project_required(df)
    assert out.columns == [*m.REQUIRED.values(), "extra"]
    assert out.first().file_url == ""


@pytest.mark.parametrize("columns, n", [("a string", 0), ("round1 string, round_2 string, a string", 2)])
def test_round_columns(spark, columns, n):
    df = spark.createDataFrame([tuple("x" for _ in columns.split(","))], columns)
    assert df.select(F.size(m.collect_round_columns(df))).first()[0] == n


def test_a_message_is_cleaned_once(spark):
    """A condition on the cleaned text would hold its whole expression again."""
    rows = spark.createDataFrame([("a \t b",)], "m string").select(text.clean_message(F.col("m")).alias("c"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count(r"[\x00-\x08\x0B\x0C") == 1
    odd = [" a", "a \n\t b", "\xa0", "a\xa0b", "\ufffd", "\ufffd \ufffd", "a \x00 b", "\x85", "\u3000a\u2003\u2003b", "$1 \\\\", "\x1f"]
    assert one(spark, text.clean_message, odd) == [
        "a", "a b", text.EMPTY_MESSAGE, "a b", text.EMPTY_MESSAGE, text.EMPTY_MESSAGE, "a b", text.EMPTY_MESSAGE, "a b", "$1 \\\\", text.EMPTY_MESSAGE]


def test_queries_share_cleaned_messages(spark):
    """What several steps need of a message is cleaned once, dealt out, and the rows are those of the plain way."""
    sf = "/root/testdata/sf0.001"
    cleaned = bases.m1_cleaned(spark, sf)
    columns = [c for c in cleaned.columns if c != "round_columns"]
    assert sorted(map(str, cleaned.select(columns).collect())) == sorted(map(str, adapters.m1(spark, sf).select(columns).collect()))
    assert "regexp_replace" not in cleaned._jdf.queryExecution().optimizedPlan().toString()
