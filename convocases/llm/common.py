"""What the operators of this package share."""

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed value: the characters that separate words, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def text_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only doc_id and text, null texts as empty ones; other columns, also of clashing names, stay behind."""
    return docs.select(
        docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def without_space(text: Column) -> Column:
    return F.translate(text, SPACE, "")
