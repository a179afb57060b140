"""A corpus from `documents` to packed sequences: toxic documents go, then copies, near copies, personal data; the rest is packed."""

from pyspark.sql import DataFrame, SparkSession

from convocases.llm import exact, minhash, packing, pii, toxicity
from convocases.llm.queries import table, word_vocabulary
from convocases.sources.scratch import checkpointed


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model fitted on `labels` rejects are gone."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space one is left."""
    return exact.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles connect at a similarity of 0.8 one is left."""
    return minhash.drop_near_duplicates(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind; all documents stay."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: a row for each piece of a document, with its ids."""
    return packing.pack(docs, word_vocabulary())


STAGES = [
    ("toxicity", without_toxic), ("exact_dedup", without_copies), ("minhash", without_near_copies),
    ("pii", without_personal_data), ("packing", packed),
]

#: The first stage is a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
