"""Both reports as long tables: `section, key, metric, value`."""

from pyspark.sql import DataFrame, functions as F

from convocases.functions import text
from convocases.operators import stats
from convocases.sources.scratch import checkpointed

REVIEW_TOTALS = ("channels_with_review", "total_review_iterations", "total_cases_reviewed", "total_cases_split")


def number(column, places: int = 3):
    return F.format_string(f"%.{places}f", F.bround(F.col(column), places))


def long_rows(df: DataFrame, section: str, key, values: dict) -> DataFrame:
    """Each row of `df` becomes one row per entry of `values` (metric name to text column)."""
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in values.items()))
    return df.select(F.lit(section).alias("section"), key.alias("key"), F.inline(pairs))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def times(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


def segmentation_report(cases: DataFrame, per_channel: DataFrame) -> DataFrame:
    """Header, confidence bands, review totals, cases, channels and verdict of a segmentation.

    The sections read the cases several times, so they are written once first.
    """
    everything = F.lit("all")
    columns = (
        "case_number", "channel_url", "case_index", "start_time", "end_time", "duration_minutes", "confidence", "summary"
    )
    cases, per_channel = checkpointed(cases.select(*columns)), checkpointed(per_channel)
    totals = stats.total_stats(per_channel)
    rate = F.try_divide(F.col("total_cases_split") * 100.0, F.col("total_cases_reviewed"))
    breakdown = stats.channel_case_summary(cases, per_channel)
    verdict = stats.confidence_verdicts(cases)
    return union_all([
        long_rows(totals, "header", everything, {
            "total_cases": F.col("total_cases"), "total_channels": F.col("total_channels"),
            "average_confidence": number("case_avg_confidence"),
        }),
        long_rows(stats.confidence_distribution(cases), "confidence", F.col("band"), {
            "cases": F.col("cases"), "label": F.col("label"),
        }),
        long_rows(totals.withColumn("_rate", F.coalesce(rate, F.lit(0.0))), "review", everything, {
            **{name: F.col(name) for name in REVIEW_TOTALS}, "split_rate": number("_rate", 1),
        }),
        long_rows(cases, "case", F.col("case_number"), {
            "channel": text.channel_label(F.col("channel_url")),
            "start_time": times("start_time"), "end_time": times("end_time"),
            "duration": F.concat(number("duration_minutes", 1), F.lit("m")),
            "confidence": number("confidence"), "summary": text.short_label(F.col("summary"), 40),
        }),
        long_rows(breakdown, "channel", F.col("channel_url"), {
            "cases": F.col("cases"), "average_confidence": number("avg_confidence"),
            "total_duration": number("total_minutes", 1), "review_status": F.col("review_status"),
        }),
        long_rows(verdict, "verdict", everything, {
            "quality": F.col("quality"), "low_warning": F.col("low_warning"),
        }),
    ])


def classification_report(classifications: DataFrame) -> DataFrame:
    """Bands, primaries, largest categories, insights, cases, verdict and recommendations.

    The sections read the classifications several times, so they are written once first.
    """
    everything = F.lit("all")
    classifications = checkpointed(classifications)
    verdict = stats.classification_verdicts(classifications)
    insights = stats.category_insights(classifications)
    return union_all([
        long_rows(verdict, "header", everything, {
            "total_classified_cases": F.col("total_cases"), "average_confidence": number("avg_confidence"),
        }),
        long_rows(stats.confidence_distribution(classifications), "confidence", F.col("band"), {
            "cases": F.col("cases"), "label": F.col("label"),
        }),
        long_rows(stats.primary_distribution(classifications), "primary", F.col("primary"), {
            "cases": F.col("cases"), "label": F.col("label"),
        }),
        long_rows(stats.top_categories(classifications), "category", F.col("display"), {
            "cases": F.coalesce(F.col("cases").cast("string"), F.lit("...")), "label": F.col("label"),
        }),
        long_rows(insights, "insight", everything, {
            "most_common_category": text.display_category(F.col("most_common_category")),
            "most_common_primary": F.col("most_common_primary"),
            "unique_categories": F.col("unique_categories"), "unique_primaries": F.col("unique_primaries"),
        }),
        long_rows(classifications, "case", F.col("case_number"), {
            "category": text.display_category(F.col("category")), "confidence": number("confidence"),
            "level": text.band_symbol(F.col("confidence")),
            "reasoning": text.short_label(F.col("reasoning"), 50), "classified_at": times("classified_at"),
        }),
        long_rows(verdict, "verdict", everything, {
            "quality": F.col("quality"), "low_warning": F.col("low_warning"), "high_praise": F.col("high_praise"),
        }),
        long_rows(verdict, "recommendation", everything, {
            "review_low_confidence": F.col("review_low"), "check_imbalance": F.col("imbalanced"),
            "improve_model": F.col("improve_model"), "regular_review": F.lit(True),
        }),
    ])
