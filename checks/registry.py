"""Registered queries with their DuckDB counterparts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES, SQL = {}, {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places, zoned timestamps as plain ones, as the SQL side gives them."""
    plain = {}
    for name, kind in df.dtypes:
        if kind == "double":
            plain[name] = F.round(name, 6)
        elif kind == "timestamp":
            plain[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(plain) if plain else df


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(fn(spark, sf))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return register
