import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def chat(spark):
    """Messages from (channel, minute, text) and, if given, sender and message id."""
    def make(rows):
        full = []
        for i, row in enumerate(rows):
            channel, minute, text, *rest = row
            sender = rest[0] if rest else "u1"
            message_id = rest[1] if len(rest) > 1 else f"m{i}"
            full.append((channel, message_id, i, float(minute), sender, "user", "MESG", text))
        df = spark.createDataFrame(
            full, "channel_url string, message_id string, ingest_seq long, minute double, sender_id string, "
            "sender_type string, type string, message string",
        )
        return df.selectExpr("* except (minute)", "timestamp_millis(cast(1704067200000 + minute * 60000 as bigint)) as created_time")
    return make
