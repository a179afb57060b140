"""Message sources: chat exports as CSV, or any table."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from convocases.operators.messages import MALFORMED, rename_source_columns
from convocases.sources import records


def with_ingest_seq(df: DataFrame, row_index: bool = False) -> DataFrame:
    """`ingest_seq` in the order of file paths, and of rows inside a file, however files are packed into partitions.

    A number is the rank of the file, then the row's number in its file where the source knows it (`row_index`: parquet),
    else the byte at which the row's split starts plus the rows read before it in its task, which for text are fewer
    than the bytes of a split. It reads nothing ahead; the ranks come from the listing Spark has. Sources without files
    are numbered as they are read.
    """
    ranks = records.file_ranks(df)
    if ranks is None:
        return df.withColumn("ingest_seq", F.monotonically_increasing_id())
    if row_index:
        rows = df.select("*", records.file_of(), F.col("_metadata.row_index").alias("_index"))
        return records.in_file_order(rows, ranks, F.col("_index")).select(*df.columns, "ingest_seq")
    rows = df.select("*", records.file_of(), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    return records.in_file_order(rows, ranks, records.place_in_file()).select(*df.columns, "ingest_seq")


def read_messages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV, all columns as text. Short and long rows are kept with their record in `_malformed`.

    `multi_line` allows line breaks in quoted cells: the borders of records are found over all splits first, at the price
    of one more pass and a copy of the lines, and Spark's own parser then reads each record. Set it to False for exports
    without such cells. `ingest_seq` follows the order of file names.
    """
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    names = spark.read.options(**options).option("multiLine", multi_line).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
    kept = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    if multi_line:
        found = records.without_headers(records.csv_records(spark, path))
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in schema.names)
        parsed = F.from_csv("record", ddl, {"quote": '"', "escape": '"', **kept})
        rows = found.select("_file", "_block", "_id", parsed.alias("_row")).select("_file", "_block", "_id", "_row.*")
        rows = records.in_file_order(rows, records.file_ranks(spark.read.text(path)), records.place_in_file()).drop("_block", "_id")
    else:
        rows = with_ingest_seq(spark.read.options(**options).csv(path, schema=schema, enforceSchema=True, **kept))
    return rename_source_columns(rows.na.fill("", names))


def load_raw_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Any table with a channel column, for runs that skip cleaning; adds what is missing of
    `review` (empty) and `ingest_seq` (by file order).
    """
    df = spark.read.format(fmt).options(**options).load(path)
    df = rename_source_columns(df if "ingest_seq" in df.columns else with_ingest_seq(df, fmt == "parquet"))
    if "channel_url" not in df.columns:
        raise ValueError("the table has no channel column")
    return df if "review" in df.columns else df.withColumn("review", F.lit(""))
