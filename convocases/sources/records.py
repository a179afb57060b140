"""Records of CSV files whose cells may hold line breaks, read by as many tasks as the files have splits."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from convocases.sources.scratch import checkpointed

# A line from the start of a record, or from inside a quoted cell, to where all its cells are closed.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_CLOSED = rf"^{_CELL}(?:,{_CELL})*+\z"
_CLOSED_FROM_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_CELL})*+\z'
_SPLIT = ["_file", "_block"]
_ROW = (1 << 33) - 1
#: Bytes of small splits that one task reads, and files whose ranks are broadcast.
BYTES_PER_TASK, MANY_FILES = 8 << 20, 100_000


def file_ranks(df: DataFrame) -> DataFrame | None:
    """`_file, _rank`: the files of a source in the order of their paths; None if it has none. Spark has this listing anyway.

    Up to MANY_FILES of them meet the rows where these are read: by a shuffle, the rows of a file would meet in one task.
    """
    files = sorted({re.sub(":/+", ":/", f, count=1) for f in df.inputFiles()})
    if not files:
        return None
    ranks = df.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "_file string, _rank long")
    return F.broadcast(ranks) if len(files) <= MANY_FILES else ranks


def in_larger_tasks(df: DataFrame) -> DataFrame:
    """The rows of a scan, its splits, where they are small, being read by tasks of BYTES_PER_TASK: each task reports to the driver."""
    spark = df.sparkSession
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    together = BYTES_PER_TASK // size
    return df.coalesce(max(1, -(-df.rdd.getNumPartitions() // together))) if together > 1 else df


def file_of() -> Column:
    return F.regexp_replace("_metadata.file_path", "^([^/]*):/+", "$1:/").alias("_file")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with `_inside`: whether they begin inside a quoted cell, for each file from its start on.

    What a line does to the state (outside or inside a cell) is one of four things: keep it, turn it, or set it to
    either. So the state before a line is what the last setting line set it to, turned by the turning lines since. That
    is one sort within each split; one row for each split then carries the state over the borders of splits.
    """
    lines = in_larger_tasks(spark.read.text(path, lineSep="\n").select(
        file_of(), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    ))
    opens = (~F.col("value").rlike(_CLOSED)).cast("int")  # inside after the line, if it began outside
    stays = (~F.col("value").rlike(_CLOSED_FROM_INSIDE)).cast("int")  # if it began inside
    lines = lines.withColumns({"_opens": opens, "_stays": stays})
    turns = ((F.col("_opens") == 1) & (F.col("_stays") == 0)).cast("int")
    before = Window.partitionBy(*_SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"_turns": turns}).withColumn("_turned", F.coalesce(F.sum("_turns").over(before), F.lit(0)) % 2)
    setting = F.when(F.col("_opens") == F.col("_stays"), (F.col("_opens") + F.col("_turned")) % 2)
    lines = in_larger_tasks(checkpointed(lines.withColumn("_sets", setting).withColumn("_set", F.last("_sets", ignorenulls=True).over(before))))

    last = lines.groupBy(*_SPLIT).agg(F.max_by(
        F.struct(((F.col("_turned") + F.col("_turns")) % 2).alias("turned"), F.coalesce("_sets", "_set").alias("set")), "_id").alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    turned, given = F.col("_last.turned"), F.col("_last.set")
    last = last.withColumn("_turned", F.coalesce(F.sum(F.when(given.isNull(), turned).otherwise(0)).over(earlier), F.lit(0)) % 2)
    known = F.when(given.isNotNull(), (given + turned + F.col("_turned")) % 2)
    start = (F.coalesce(F.last(known, ignorenulls=True).over(earlier), F.lit(0)) + F.col("_turned")) % 2
    starts = last.select(*_SPLIT, start.alias("_start"))
    inside = (F.coalesce("_set", "_start") + F.col("_turned")) % 2 == 1
    return lines.join(starts, _SPLIT).withColumn("_inside", inside).select(*_SPLIT, "_id", "value", "_opens", "_stays", "_inside")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """`_file, _block, _id, record`: the records of CSV files, header lines included, in the order (file, _block, _id).

    Cells are quoted with " and a quote inside is doubled; a quote within a cell that doesn't start with one means
    itself. A record of one line stays where it was read; only lines of longer records move, to the line that opens them,
    which may lie in any earlier split. Line ends may be LF or CRLF and are LF inside records; empty lines are left out.
    """
    lines = placed_lines(spark, path)
    whole = lines.where(~F.col("_inside") & (F.col("_opens") == 0) & (F.col("value") != ""))
    parts = in_larger_tasks(checkpointed(lines.where(F.col("_inside") | (F.col("_opens") == 1)).select(*_SPLIT, "_id", "value", "_inside")))
    opener = F.when(~F.col("_inside"), F.struct("_block", "_id"))
    upto = Window.partitionBy(*_SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_own", F.last(opener, ignorenulls=True).over(upto))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = parts.groupBy(*_SPLIT).agg(F.max("_own").alias("_last"))
    splits = splits.select(*_SPLIT, F.last("_last", ignorenulls=True).over(earlier).alias("_open"))
    parts = parts.join(splits, _SPLIT).withColumn("_at", F.coalesce("_own", "_open"))
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_id", "value")))  # the lines of one record
    joined = parts.groupBy("_file", "_at").agg(F.array_join(F.transform(pieces, lambda x: x["value"]), "\n").alias("record"))
    return whole.select(*_SPLIT, "_id", F.col("value").alias("record")).unionByName(
        joined.select("_file", F.col("_at._block").alias("_block"), F.col("_at._id").alias("_id"), "record"))


def in_file_order(rows: DataFrame, ranks: DataFrame, place: Column) -> DataFrame:
    """`ingest_seq` from the rank of `_file` and a place inside the file below 2^42."""
    return rows.withColumn("_place", place).join(ranks, ["_file"], "left").withColumn("ingest_seq", F.col("_rank") * (1 << 42) + F.col("_place")).drop(
        "_file", "_rank", "_place")


def without_headers(records: DataFrame) -> DataFrame:
    """The records but for the first of each file."""
    first = records.where(F.col("_block") == 0).groupBy("_file").agg(F.min("_id").alias("_id")).withColumn("_block", F.lit(0).cast("long"))
    return records.join(first, ["_file", "_block", "_id"], "left_anti")


def place_in_file() -> Column:
    """The byte at which a row's split starts plus the rows read before it in its task, which are fewer than the bytes of a split."""
    return F.col("_block") + F.col("_id").bitwiseAND(_ROW)
