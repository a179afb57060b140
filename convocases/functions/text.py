"""Column functions for message text, labels and numbers. All run inside the JVM."""

from pyspark.sql import Column, functions as F

# Markers, limits and patterns the results must reproduce.
EMPTY_MESSAGE = "[empty message]"
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
#: Those and the replacement character.
DROPPED_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\uFFFD]"
#: Whitespace that is not a single blank already, so plain text has no match.
UNTIDY_SPACE = r"(?U)\s\s+|[^\S ]"
MAX_MESSAGE_LENGTH = 500
AGENT_ID_PREFIX = "psops"
AGENT, CUSTOMER = "customer_service", "user"
HIGH_CONFIDENCE, MEDIUM_CONFIDENCE = 0.8, 0.5

# A calendar date is required; time, fraction and offset are optional.
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.]\d{1,6})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def straighten_quotes(text: Column) -> Column:
    """Curly single and double quotes become plain ones."""
    return F.translate(text, "“”‘’", "\"\"''")


def truncate_message(text: Column, limit: int = MAX_MESSAGE_LENGTH) -> Column:
    """Texts longer than `limit` keep their first `limit - 3` characters and get an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def clean_message(text: Column, straighten: bool = False, limit: int | None = None) -> Column:
    """Drop control and replacement characters, collapse whitespace, trim.

    A missing or empty text gives '', a text that cleans to nothing gives a marker. Curly quotes are
    kept unless `straighten` is set; nothing is shortened unless `limit` is given. The marker is put in by a pattern, since
    a condition on the cleaned text would have it cleaned once more.
    """
    kept = F.regexp_replace(text, DROPPED_CHARS, "")
    if straighten:
        kept = straighten_quotes(kept)
    tidy = F.trim(F.regexp_replace(kept, UNTIDY_SPACE, " "))
    if limit:
        tidy = truncate_message(tidy, limit)
    marked = F.regexp_replace(tidy, r"\A\z", EMPTY_MESSAGE)
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(marked)


def parse_created_time(raw: Column) -> Column:
    """ISO-8601 text to timestamp; null where it is empty or not a full date."""
    hour_only = F.regexp_replace(raw, r"([T ]\d{2})(?=Z|[+-]|$)", "$1:00")
    return F.when(raw.rlike(ISO_TIME), hour_only.try_cast("timestamp"))


def derive_sender_type(sender_type: Column, sender_id: Column) -> Column:
    """Keep a given sender type, else tell agents from customers by the id prefix."""
    guess = F.when(F.coalesce(sender_id, F.lit("")).startswith(AGENT_ID_PREFIX), AGENT).otherwise(CUSTOMER)
    return F.when(F.coalesce(sender_type, F.lit("")) == "", guess).otherwise(sender_type)


def approx_tokens(text: Column) -> Column:
    """Four characters count as one token."""
    return F.floor(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def combine_category(primary: Column, secondary: Column) -> Column:
    """`Primary_Secondary`; only the secondary part has its dashes and blanks turned to underscores."""
    flat = F.replace(F.replace(secondary, F.lit(" - "), F.lit("_")), F.lit(" "), F.lit("_"))
    return F.concat(primary, F.lit("_"), flat)


def primary_of_category(category: Column) -> Column:
    return F.substring_index(category, "_", 1)


def display_category(category: Column) -> Column:
    return F.replace(F.replace(category, F.lit("_"), F.lit(" - ")), F.lit("  "), F.lit(" "))


def clamp_confidence(value: Column) -> Column:
    """A number, or text of one, cut to [0, 1]; null for anything else."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def confidence_band(value: Column) -> Column:
    return F.when(value >= HIGH_CONFIDENCE, "high").when(value >= MEDIUM_CONFIDENCE, "medium").otherwise("low")


def band_symbol(value: Column) -> Column:
    return F.when(value >= HIGH_CONFIDENCE, "🟢").when(value >= MEDIUM_CONFIDENCE, "🟡").otherwise("🔴")


def case_id(number: Column) -> Column:
    return F.format_string("CASE_%04d", number)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 6e7


def channel_label(channel_url: Column, width: int = 15) -> Column:
    """Last underscore token of a channel, cut to `width` and always marked with an ellipsis."""
    return F.concat(F.substring(F.substring_index(channel_url, "_", -1), 1, width), F.lit("..."))


def short_label(text: Column, width: int) -> Column:
    """Texts longer than `width` are cut there and marked with an ellipsis."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def percent_label(part: Column, whole: Column) -> Column:
    """`n (p.p%)`, with 0.0 where the whole is zero."""
    share = F.bround(F.coalesce(percent(part, whole), F.lit(0.0)), 1)
    return F.format_string("%d (%.1f%%)", part, share)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays; null where either has no length."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
