"""Exact duplicates: local, salted and global combining of whole contents."""

from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import text_of, without_space
from convocases.sources.scratch import checkpointed

#: Parts into which every group of copies is dealt before its parts' winners meet.
SALTS = 64

_TWO_64 = "cast(18446744073709551616 as decimal(20,0))"
_LAST_ID = "cast(9223372036854775807 as decimal(20,0))"


def _rank() -> Column:
    """One fixed-width number, so that a hash aggregate can keep its maximum: long texts first, then small ids, null ids last."""
    return F.expr(
        f"cast(cast(n_chars as decimal(10,0)) * {_TWO_64} + coalesce({_LAST_ID} - cast(doc_id as decimal(20,0)), 0) as decimal(38,0))"
    )


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when they are identical without white space. The longest original stays, then the smallest doc_id.

    Groups are compared by their whole content, not by a digest alone, at each of three stages: the map side of the
    first aggregate drops the copies within a task, its reduce side merges the groups by (digest, salt, content), and
    the second aggregate merges the winners of the salts. So a group that holds a third of all rows meets as at most
    `salts` rows. The rows then look up their group by digest; adaptive execution splits that join where a digest is hot.

    A null text counts as empty, and all empty texts are one group. Rows with a null doc_id take part, but stay only
    where no other row is as long; their keep_id is then null. Rows that repeat a doc_id count as rows of their own in
    group_size, and where they tie with the row that stays all of them have kept = true. An empty table gives no rows.
    """
    content = without_space(F.col("text"))
    rows = text_of(docs).select(
        "doc_id", F.length("text").alias("n_chars"), content.alias("content"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
    )
    merged = (
        rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "content")
        .agg(F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("n"))
    )
    groups = (
        merged.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
        .select(
            "digest", "group_size", F.expr(f"cast(best div {_TWO_64} as int)").alias("longest"),
            F.expr(f"cast(nullif({_LAST_ID} - cast(best % {_TWO_64} as decimal(20,0)), {_LAST_ID}) as bigint)").alias("keep_id"),
        )
    )
    return rows.select("doc_id", "n_chars", "digest").join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("longest"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "n_chars",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, one for each group of equal texts, with the columns of `docs`.

    Rows are told by doc_id, digest of the text without white space, and length, so a doc_id (or null) that repeats with
    different texts stays with each of them. Where a group's doc_id repeats with the same length, any one of these rows stays.
    """
    key = ["doc_id", "text_sha256", "n_chars"]
    kept = checkpointed(exact_duplicates(docs).where("kept").groupBy(*key).count())
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        F.sha2(without_space(text).cast("binary"), 256).alias("text_sha256"), F.length(text).alias("n_chars"),
    )

    def those(found: DataFrame) -> DataFrame:
        same = [rows[c].eqNullSafe(found[c]) for c in key]
        return rows.join(found, same[0] & same[1] & same[2], "left_semi")

    often = kept.where("count > 1")
    if often.isEmpty():
        return those(kept).select("row.*")
    return those(kept.where("count = 1")).unionByName(those(often).dropDuplicates(key)).select("row.*")
