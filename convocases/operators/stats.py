"""Counts, shares and verdicts over messages, cases, replies and classifications."""

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from convocases.functions import text
from convocases.operators.channels import channel_counts
from convocases.operators.messages import has_ids

# Thresholds of the verdicts.
GOOD_QUALITY, MODERATE_QUALITY = 0.7, 0.5
MANY_LOW, MANY_HIGH, IMBALANCE, WEAK_MODEL = 0.3, 0.7, 0.5, 0.6
PIPELINE_HIGH, PIPELINE_MEDIUM = 0.8, 0.6
COVERAGE_HIGH, COVERAGE_MEDIUM = 0.9, 0.7
TOP_CATEGORIES = 15


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def preprocess_stats(raw: DataFrame, selected: DataFrame | None = None, malformed: str | None = None) -> DataFrame:
    """One row: rows in all, processed, filtered and malformed, channels found and selected.

    `selected` lists channels (column `channel_url`) and is joined to per-channel counts, not to the rows.
    """
    bad = F.col(malformed).isNotNull() if malformed else F.lit(False)
    per_channel = raw.groupBy("channel_url").agg(
        F.count(F.lit(1)).alias("total"), count_if(~bad & has_ids()).alias("usable"), count_if(bad).alias("errors")
    )
    if selected is None:
        wanted, n_selected = F.lit(True), F.lit(0)
    else:
        chosen = selected.select("channel_url", F.lit(True).alias("_chosen")).distinct()
        per_channel = per_channel.join(chosen, ["channel_url"], "left")
        wanted, n_selected = F.col("_chosen").isNotNull(), F.count("_chosen")
    processed = F.when(wanted, F.col("usable")).otherwise(0)
    return per_channel.agg(
        F.sum("total").alias("total_rows"),
        F.sum(processed).alias("processed_rows"),
        F.sum(F.col("total") - F.col("errors") - processed).alias("filtered_rows"),
        F.sum("errors").alias("error_rows"),
        count_if(processed > 0).alias("channels_found"),
        n_selected.cast("long").alias("channels_selected"),
    )


def observed_rows(raw: DataFrame, malformed: str | None = None) -> tuple[DataFrame, Observation]:
    """The same rows, with the row counts of `preprocess_stats` taken while another action reads them."""
    seen = Observation("preprocess")
    bad = F.col(malformed).isNotNull() if malformed else F.lit(False)
    counts = {"total_rows": F.lit(True), "processed_rows": ~bad & has_ids(), "error_rows": bad}
    return raw.observe(seen, *(count_if(c).alias(n) for n, c in counts.items())), seen


def channel_stats(sizes: DataFrame, cases: DataFrame, replies: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Per channel: messages, cases, tokens, calls, seconds and review counters. Failed calls do not count."""
    found = cases.groupBy("channel_url").agg(
        F.count(F.lit(1)).alias("cases_found"),
        F.sum("confidence").alias("confidence_sum"),
    )
    spent = replies.where(F.col("error").isNull()).groupBy("channel_url").agg(
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.count(F.lit(1)).alias("calls"), F.sum("seconds").alias("seconds"),
    )
    rows = sizes.select("channel_url", F.col("n_messages").alias("total_messages"))
    rows = rows.join(found, ["channel_url"], "left").join(spent, ["channel_url"], "left")
    counters = ("review_iterations", "cases_reviewed", "cases_split")
    if reviews is not None:
        rows = rows.join(reviews.select("channel_url", *counters), ["channel_url"], "left")
    else:
        rows = rows.withColumns({c: F.lit(0) for c in counters})
    whole = ("total_messages", "cases_found", "input_tokens", "output_tokens", "calls", *counters)
    return rows.select(
        "channel_url",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in whole),
        *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("seconds", "confidence_sum")),
    )


def total_stats(per_channel: DataFrame) -> DataFrame:
    """Sums over the rows of `channel_stats`, with the mean confidence over cases."""
    return per_channel.agg(
        F.sum("cases_found").alias("total_cases"),
        F.count(F.lit(1)).alias("total_channels"),
        F.sum("input_tokens").alias("total_input_tokens"),
        F.sum("output_tokens").alias("total_output_tokens"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
        F.sum("calls").alias("total_calls"),
        F.sum("seconds").alias("total_seconds"),
        F.coalesce(F.try_divide(F.sum("confidence_sum"), F.sum("cases_found")), F.lit(0.0)).alias("case_avg_confidence"),
        F.sum("review_iterations").alias("total_review_iterations"),
        F.sum("cases_reviewed").alias("total_cases_reviewed"),
        F.sum("cases_split").alias("total_cases_split"),
        count_if(F.col("review_iterations") > 0).alias("channels_with_review"),
    )


def shares(counted: DataFrame) -> DataFrame:
    """Adds `share` and `label` to a table of `cases` counts, one row per band or category."""
    whole = F.sum("cases").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("_all", whole).withColumns({
        "share": text.percent(F.col("cases"), F.col("_all")),
        "label": text.percent_label(F.col("cases"), F.col("_all")),
    }).drop("_all")


def side_by_side(*tables: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def confidence_distribution(cases: DataFrame) -> DataFrame:
    counted = cases.groupBy(text.confidence_band(F.col("confidence")).alias("band")).agg(F.count(F.lit(1)).alias("cases"))
    return shares(counted)


def category_distribution(classifications: DataFrame) -> DataFrame:
    counted = classifications.groupBy("category").agg(F.count(F.lit(1)).alias("cases"))
    return shares(counted)


def primary_distribution(classifications: DataFrame) -> DataFrame:
    primary = text.primary_of_category(F.col("category")).alias("primary")
    counted = classifications.groupBy(primary).agg(F.count(F.lit(1)).alias("cases"))
    return shares(counted)


def category_insights(classifications: DataFrame) -> DataFrame:
    """One row: most common category and primary with their counts (ties: first by name), distinct counts."""
    primary = text.primary_of_category(F.col("category")).alias("primary")
    levels = classifications.groupBy(primary, "category").agg(F.count(F.lit(1)).alias("cases"))
    by_primary = levels.groupBy("primary").agg(
        F.sum("cases").alias("cases"), F.count(F.lit(1)).alias("categories"),
        F.min(F.struct((-F.col("cases")).alias("n"), "category")).alias("_top"),
    )
    top = by_primary.agg(
        F.min("_top").alias("_category"), F.min(F.struct((-F.col("cases")).alias("n"), "primary")).alias("_primary"),
        F.sum("categories").alias("unique_categories"), F.count(F.lit(1)).alias("unique_primaries"),
    )
    return top.select(
        F.col("_category.category").alias("most_common_category"), (-F.col("_category.n")).alias("category_cases"),
        F.col("_primary.primary").alias("most_common_primary"), (-F.col("_primary.n")).alias("primary_cases"),
        "unique_categories", "unique_primaries",
    )


def channel_case_summary(cases: DataFrame, per_channel: DataFrame) -> DataFrame:
    """Per channel with cases: number, mean confidence, total duration, review counters."""
    found = cases.groupBy("channel_url").agg(
        F.count(F.lit(1)).alias("cases"), F.avg("confidence").alias("avg_confidence"),
        F.sum("duration_minutes").alias("total_minutes"),
    )
    counters = per_channel.select("channel_url", "review_iterations", "cases_reviewed", "cases_split")
    reviewed = F.when(F.col("review_iterations") > 0, "reviewed").otherwise("none")
    return found.join(counters, ["channel_url"]).withColumn("review_status", reviewed)


def top_categories(classifications: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The `n` largest categories and, where there are more, one row that counts the rest."""
    dist = category_distribution(classifications)
    top = dist.orderBy(F.desc("cases"), "category").limit(n).select(
        F.col("category"), text.display_category(F.col("category")).alias("display"), "cases", "label"
    )
    rest = dist.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("_rest")).where(F.col("_rest") > 0).select(
        F.lit("").alias("category"), F.format_string("... and %d more categories", F.col("_rest")).alias("display"),
        F.lit(None).cast("long").alias("cases"), F.lit("...").alias("label"),
    )
    return top.unionByName(rest)


def sorted_cases(cases: DataFrame) -> DataFrame:
    return cases.orderBy("channel_url", "start_time", "case_index")


def distinct_non_empty(column: str) -> Column:
    return F.count_distinct(F.when(F.col(column) != "", F.col(column)))


def pipeline_summary(raw_rows: DataFrame, final: DataFrame, legacy_counts: bool = False) -> DataFrame:
    """One row over the whole run: rows in and out, channels, cases, coverage and two mean confidences.

    `row_avg_confidence` counts every row, unassigned ones with 0. `legacy_counts` lets the empty case id
    and category count as values of their own.

    Rows are first reduced to one per (case, category), which also spares a distinct count over all rows.
    """
    score = F.col("classification_confidence")
    groups = final.groupBy("case_number", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("case_confidence").alias("case_sum"),
        F.sum(F.when(score > 0, score)).alias("class_sum"), count_if(score > 0).alias("class_n"),
    )
    unique = F.count_distinct if legacy_counts else distinct_non_empty
    both = (F.col("category") != "") & (F.col("case_number") != "")
    row = groups.agg(
        F.sum("n").alias("output_rows"),
        unique("case_number").alias("unique_cases"),
        F.try_divide(F.sum("case_sum"), F.sum("n")).alias("row_avg_confidence"),
        F.count_distinct(F.when(both, F.col("case_number"))).alias("classified_cases"),
        unique("category").alias("unique_categories"),
        F.try_divide(F.sum("class_sum"), F.sum("class_n")).alias("avg_classification_confidence"),
    )
    channels = channel_counts(final).agg(F.count(F.lit(1)).alias("channels"))
    out = side_by_side(raw_rows.agg(F.count(F.lit(1)).alias("input_rows")), row, channels)
    return out.withColumn("coverage", F.try_divide("classified_cases", "unique_cases"))


def quality(mean: Column) -> Column:
    return F.when(mean >= GOOD_QUALITY, "good").when(mean >= MODERATE_QUALITY, "moderate").otherwise("poor")


def confidence_verdicts(cases: DataFrame) -> DataFrame:
    """One row over cases or classifications: mean, low and high counts, and what follows from them."""
    score = F.col("confidence")
    row = cases.agg(
        F.count(F.lit(1)).alias("total_cases"), F.avg(score).alias("avg_confidence"),
        count_if(score < text.MEDIUM_CONFIDENCE).alias("low_cases"),
        count_if(score >= text.HIGH_CONFIDENCE).alias("high_cases"),
    )
    return row.withColumns({
        "quality": quality(F.col("avg_confidence")),
        "low_warning": F.col("low_cases") > F.col("total_cases") * MANY_LOW,
        "high_praise": F.col("high_cases") > F.col("total_cases") * MANY_HIGH,
        "review_low": F.col("low_cases") > 0,
        "improve_model": F.coalesce(F.col("avg_confidence") < WEAK_MODEL, F.lit(False)),
    })


def classification_verdicts(classifications: DataFrame) -> DataFrame:
    """As `confidence_verdicts` (on the mean rounded to three places), with category imbalance."""
    row = confidence_verdicts(classifications.select("confidence"))
    mean = F.round("avg_confidence", 3)
    top = primary_distribution(classifications).agg(F.max("cases").alias("_top"))
    return side_by_side(row, top).withColumns({
        "quality": quality(mean),
        "improve_model": F.coalesce(mean < WEAK_MODEL, F.lit(False)),
        "imbalanced": F.coalesce(F.col("_top") > F.col("total_cases") * IMBALANCE, F.lit(False)),
    }).drop("_top")


def pipeline_verdicts(summary: DataFrame) -> DataFrame:
    mean, coverage = F.col("row_avg_confidence"), F.col("coverage")
    return summary.withColumns({
        "segmentation_grade": F.when(mean >= PIPELINE_HIGH, "high").when(mean >= PIPELINE_MEDIUM, "medium").otherwise("low"),
        "coverage_grade": F.when(coverage >= COVERAGE_HIGH, "high").when(coverage >= COVERAGE_MEDIUM, "medium")
        .when(coverage.isNotNull(), "low"),
    })


def token_usage(replies: DataFrame) -> DataFrame:
    """Tokens, calls and seconds per channel, per (provider, model) and in all; `level` tells them apart."""
    good = replies.where(F.col("error").isNull())
    per_key = good.groupBy("channel_url", "provider", "model").agg(
        F.sum("input_tokens").alias("i"), F.sum("output_tokens").alias("o"),
        F.count(F.lit(1)).alias("c"), F.sum("seconds").alias("s"),
    )
    sets = [[F.col("channel_url")], [F.col("provider"), F.col("model")], []]
    usage = per_key.groupingSets(sets, F.col("channel_url"), F.col("provider"), F.col("model")).agg(
        F.grouping_id().alias("_g"),
        F.sum("i").cast("long").alias("input_tokens"), F.sum("o").cast("long").alias("output_tokens"),
        F.sum("c").alias("calls"), F.sum("s").alias("seconds"),
    )
    level = F.when(F.col("_g") == 3, "channel").when(F.col("_g") == 4, "model").otherwise("all")
    return usage.withColumn("level", level).drop("_g")
