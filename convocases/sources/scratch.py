"""Shared scratch space for steps that are read more than once."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which the shuffle files of a query go when it has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Takes about two thirds of the space of Spark's default.
DENSE = {"compression": "zstd"}
_local: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; a temporary one only for a local session."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.applicationId not in _local:
        _local[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local[spark.sparkContext.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Removes what this application has written to the shared folder so far, and gives the number of tables and files.

    Call it when results are written elsewhere: frames that still read from the folder fail afterwards.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def checkpointed(df: DataFrame, **options: str) -> DataFrame:
    """Written as a table to the shared folder and read from there.

    The lineage ends here and outlives lost executors; later reads take only the columns they need. Nothing reads the
    shuffles behind a written step again, so their files go at once; else Spark keeps them until the driver collects garbage.
    `options` are the parquet writer's; `DENSE` is for steps with the texts or ids of all messages.
    """
    spark = df.sparkSession
    path = new_path(spark, "step")
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
