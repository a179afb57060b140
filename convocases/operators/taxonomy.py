"""Two-level category table: primary, secondary. Callers may pass their own."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_TAXONOMY_ROWS = 10_000

# The category names results must match, in their order.
TAXONOMY = {
    "Order": [
        "Order - Status", "Order - Cancel", "Order - Update", "Order - Failure", "Order - Missing Coupon",
        "Refund - Status", "Refund - Request", "Refund - Full", "Refund - Partial", "Giveaway", "Other",
    ],
    "Shipment": [
        "Shipment - Status", "Shipment - Delay", "Shipment - Lost", "Shipment - Wrong Address",
        "Shipment - Reshipping", "Shipment - Local Pickup", "Shipment - Carrier Claim", "Update - Address",
        "Update - Carrier", "Update - Shipping Label", "Item - Damaged", "Item - Missing", "Item - Wrong",
        "Tracking - Status", "Tracking - Invalid", "Tracking - Status Not Updating",
        "Tracking - False Completion", "Other",
    ],
    "Payment": [
        "Payment - Status", "Payment - Verification", "Payment - Failure", "Payment - Dispute",
        "Payment - Chargeback", "Update - Method", "Withdrawal - Status", "Withdrawal - Delay",
        "Withdrawal - Method", "Coupon - Redemption", "Coupon - Redemption Failure", "Pay by Credit", "Other",
    ],
    "Tax and Fee": ["Sales Fee", "Sales Tax", "Invoice", "Tax Information", "Form 1099", "Other"],
    "User": [
        "Update - Username", "Update - Email", "Update - Password", "Account - Delete", "Account - Recover", "Other",
    ],
    "Seller": [
        "Application - Request", "Application - Rejection", "Application - Additional Materials",
        "Application - Trust Review", "Foundation Plan - Enroll", "Foundation Plan - Update",
        "Foundation Plan - Cancel", "Live Quota", "Other",
    ],
    "App Functionality": [
        "Login", "Logout", "Settings", "Live", "Live Auction", "Purge", "Marketplace", "Long-Form Auction", "Bug",
        "OBS Connection", "Permission", "Content Moderation", "System Update", "Other",
    ],
    "Referral and Promotion": [
        "Referral Bonus - Information", "Referral Bonus - Not Received", "Credit", "Gift", "Other",
    ],
    "Other": [
        "Issue - Resolved", "Issue - Reopened", "Feedback", "Complaint", "Copyright", "Courtesy", "Other",
    ],
}

STOP_WORDS = ("and", "by", "not", "other")


def taxonomy_table(spark: SparkSession, taxonomy: dict[str, list[str]] | None = None) -> DataFrame:
    """`primary_no, leaf_no, primary, secondary`; names at most `MAX_TAXONOMY_ROWS` leaves."""
    taxonomy = taxonomy or TAXONOMY
    if sum(map(len, taxonomy.values())) > MAX_TAXONOMY_ROWS:
        raise ValueError(f"a taxonomy may have {MAX_TAXONOMY_ROWS} leaves")
    groups = F.array(*(
        F.struct(F.lit(name).alias("primary"), F.array(*map(F.lit, leaves)).alias("leaves"))
        for name, leaves in taxonomy.items()
    ))
    primaries = spark.range(1).select(F.posexplode(groups).alias("primary_no", "_group"))
    rows = primaries.select("primary_no", "_group.primary", F.posexplode("_group.leaves").alias("leaf_no", "secondary"))
    return rows.select("primary_no", "leaf_no", "primary", "secondary")


def small(taxonomy: DataFrame) -> DataFrame:
    """A broadcast of the taxonomy if it is as small as it should be, else the plain table."""
    return F.broadcast(taxonomy) if taxonomy.limit(MAX_TAXONOMY_ROWS + 1).count() <= MAX_TAXONOMY_ROWS else taxonomy


def leaf_words(taxonomy: DataFrame) -> DataFrame:
    """`primary, secondary, word, n_words`: distinct lower-case words of each leaf without stop words."""
    label = F.lower(F.concat_ws(" ", "primary", "secondary"))
    words = F.array_distinct(F.filter(F.split(label, "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*STOP_WORDS)))
    leaves = taxonomy.select("primary", "secondary", words.alias("_words"))
    return leaves.select("primary", "secondary", F.size("_words").alias("n_words"), F.explode("_words").alias("word"))


def leaf_index(taxonomy: DataFrame) -> DataFrame:
    """`key, words, primary_no, leaf_no, primary, secondary`: a row per leaf, by the word of it that fewest leaves have.

    Ties of `key` go to the first word. So words that many leaves share, as those of a primary, list no leaves. Leaves
    without words beside stop words are left out.
    """
    places = taxonomy.groupBy("primary", "secondary").agg(F.min(F.struct("primary_no", "leaf_no")).alias("_place"))
    words = leaf_words(taxonomy.select("primary", "secondary").distinct())
    spread = words.join(words.groupBy("word").agg(F.count(F.lit(1)).alias("_leaves")), ["word"])
    keys = spread.groupBy("primary", "secondary").agg(
        F.min(F.struct("_leaves", "word")).alias("_key"), F.sort_array(F.collect_list("word")).alias("words"))
    return keys.join(places, ["primary", "secondary"]).select(
        F.col("_key.word").alias("key"), "words", "_place.primary_no", "_place.leaf_no", "primary", "secondary")


def format_leaves(leaves: Column) -> Column:
    """The text of `format_taxonomy` for an array of structs `primary_no, leaf_no, primary, secondary`."""
    ordered = F.sort_array(leaves)

    def line(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(ordered, i - 1)["primary_no"])
        head = F.concat(F.when(i > 0, "\n").otherwise(""), F.lit("**"), x["primary"], F.lit(":**\n"))
        return F.concat(F.when(before.eqNullSafe(x["primary_no"]), "").otherwise(head), F.lit("  - "), x["secondary"], F.lit("\n"))

    return F.array_join(F.transform(ordered, line), "")


def format_taxonomy(taxonomy: DataFrame) -> DataFrame:
    """The taxonomy as one text: a bold line per primary, its leaves below, a blank line between.

    The text is one row, so it is meant for tables within `MAX_TAXONOMY_ROWS`; prompts from larger ones name the
    candidates of each case instead (`classify.candidate_leaves`).
    """
    leaves = F.transform(F.sort_array(F.collect_list(F.struct("leaf_no", "secondary"))),
                         lambda x: F.concat(F.lit("  - "), x["secondary"]))
    groups = taxonomy.groupBy("primary_no", "primary").agg(leaves.alias("_leaves"))
    block = F.concat(F.lit("**"), F.col("primary"), F.lit(":**\n"), F.array_join("_leaves", "\n"), F.lit("\n"))
    texts = groups.select("primary_no", block.alias("_text"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("primary_no", "_text"))), lambda x: x["_text"])
    return texts.agg(F.array_join(ordered, "\n").alias("taxonomy_text"))
