"""Channel counts, bands, selection; statistics that need their own rows; the log of calls."""

import pytest

from convocases.operators import channels, review, stats
from convocases.operators.messages import message_positions
from convocases.plans import requests
from convocases.sources import sinks

SIZES = {"big": 51, "bigger": 80, "edge": 50, "ten": 10, "nine": 9, "": 4}


@pytest.fixture
def counts(spark):
    rows = [(c,) for c, n in SIZES.items() for _ in range(n)]
    return channels.channel_counts(spark.createDataFrame(rows, "channel_url string"))


def test_bands(counts):
    assert {r.channel_url for r in counts.collect()} == set(SIZES) - {""}
    bands = {r.size_band: (r.channels, r.largest) for r in channels.channel_size_bands(counts).collect()}
    assert bands == {"many": (2, 80), "medium": (2, 50), "few": (1, 9), "all": (5, 80)}


def test_one_channel_per_band(spark, counts):
    ranked = {r.size_band: r.channel_url for r in channels.representative_channels(counts, by_rank=True).collect()}
    assert ranked == {"many": "bigger", "medium": "edge", "few": "nine"}
    picks = {channels.representative_channels(counts, seed=s).where("size_band = 'many'").first().channel_url for s in range(12)}
    assert picks == {"big", "bigger"}
    assert channels.representative_channels(counts, seed=3).collect() == channels.representative_channels(counts, seed=3).collect()
    many = spark.range(1, 8).selectExpr("'c' || id as channel_url", "100 + id as n_messages")
    picks = {channels.representative_channels(many, seed=s).first().channel_url for s in range(25)}
    assert picks <= {"c3", "c4", "c5", "c6", "c7"} and len(picks) > 2
    plan = channels.representative_channels(counts)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_channel_filter(spark, chat):
    messages = chat([(c, i, "x") for c in ("a", "b", "c") for i in range(3)])
    wanted = spark.createDataFrame([("a",), ("zz",), ("a",)], "channel_url string")
    none = wanted.where("false")
    assert channels.filter_channels(messages, wanted).count() == 3
    assert channels.filter_channels(messages, ["a", "b"]).count() == 6
    assert channels.filter_channels(messages, []).count() == channels.filter_channels(messages, none).count() == 9
    assert channels.filter_channels(messages, none, "none").count() == channels.filter_channels(messages, [], "none").count() == 0
    assert [r.channel_url for r in channels.missing_channels(messages, wanted).collect()] == ["zz"]


def test_long_selection_is_joined(spark, chat, monkeypatch):
    monkeypatch.setattr(channels, "BROADCAST_CHANNELS", 1)
    messages = chat([(c, i, "x") for c in ("a", "b", "c") for i in range(3)])
    wanted = spark.createDataFrame([("a",), ("b",), ("zz",)], "channel_url string")
    assert sorted({r.channel_url for r in channels.filter_channels(messages, wanted).collect()}) == ["a", "b"]


CLASS = "case_number string, category string, confidence double"


def test_insights_break_ties_by_name(spark):
    rows = [("1", "B_x", 0.9), ("2", "A_y", 0.9), ("3", "B_z", 0.2), ("4", "A_y", 0.9), ("5", "B_x", 0.9)]
    row = stats.category_insights(spark.createDataFrame(rows, CLASS)).first()
    assert (row.most_common_category, row.category_cases, row.most_common_primary, row.primary_cases) == ("A_y", 2, "B", 3)
    assert (row.unique_categories, row.unique_primaries) == (3, 2)


def test_verdicts(spark):
    rows = spark.createDataFrame([("1", "A_x", 0.9), ("2", "A_x", 0.1), ("3", "B_x", 0.2)], CLASS)
    row = stats.classification_verdicts(rows).first()
    assert (row.quality, row.low_warning, row.high_praise, row.imbalanced, row.improve_model, row.review_low) == (
        "poor", True, False, True, True, True)


def test_top_categories_count_the_rest(spark):
    rows = [(str(i), f"P_{i:02d}", 0.5) for i in range(20) for _ in range(20 - i)]
    out = stats.top_categories(spark.createDataFrame(rows, CLASS)).collect()
    assert len(out) == 16 and out[-1].display == "... and 5 more categories" and out[0].cases == 20


def test_channel_stats_with_reviews(spark):
    sizes = spark.createDataFrame([("a", 5), ("b", 3)], "channel_url string, n_messages long")
    cases = spark.createDataFrame([("a", 0.5), ("a", 0.7)], "channel_url string, confidence double")
    replies = spark.createDataFrame(
        [("a", 10, 2, 0.5, None), ("a", 5, 1, 0.25, None), ("b", 7, 7, 1.0, "timeout")],
        "channel_url string, input_tokens long, output_tokens long, seconds double, error string")
    reviews = spark.createDataFrame([("a", 1, 2, 1)], "channel_url string, review_iterations int, cases_reviewed int, cases_split int")
    per = stats.channel_stats(sizes, cases, replies, reviews)
    rows = {r.channel_url: r for r in per.collect()}
    assert (rows["a"].calls, rows["a"].input_tokens, rows["a"].cases_reviewed) == (2, 15, 2)
    assert (rows["b"].calls, rows["b"].input_tokens, rows["b"].cases_found) == (0, 0, 0)
    total = stats.total_stats(per).first()
    assert (total.total_cases, total.channels_with_review, round(total.case_avg_confidence, 6)) == (2, 1, 0.6)


def test_log_of_review_calls_samples_inside_the_case(spark, chat):
    positioned = message_positions(chat([("a", i, f"text {i}") for i in range(9)]))
    bounds = spark.createDataFrame([("a", 0, 1, 4), ("a", 1, 5, 9)], "channel_url string, case_index long, start_pos long, end_pos long")
    asked = requests.review_requests(bounds, positioned)
    replies = asked.selectExpr(
        "request_id", "'{}' as content", "'m' as model", "'p' as provider", "1L as input_tokens", "1L as output_tokens",
        "0.1D as seconds", "cast(null as string) as error")
    rows = {r.case_index: r for r in sinks.interaction_log(asked, replies, positioned).collect()}
    assert rows[1].sample.split("\n") == ["Message 1: [u1] text 4...", "Message 2: [u1] text 5...", "Message 3: [u1] text 6..."]
    assert rows[0].status == "success" and rows[0].call_type == "review"
    assert review.read_reviews(replies.selectExpr("request_id", "'a' as channel_url", "0L as case_index", "content", "error")).count() == 0
