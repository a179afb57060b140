"""Readers and sinks: malformed files, round trips, label write-back."""

import json
import random

import pytest
from pyspark.sql import functions as F

from checks import tables_and_text
from convocases.operators import stats
from convocases.operators.cases import cases_of_boundaries, number_cases
from convocases.operators.messages import message_positions
from convocases.sources import readers, records, sinks
from convocases.sources.scratch import new_path

HEADER = "Created Time,Sender ID,Message,Message ID,Type,Channel URL,Sender Type,extra\n"


def test_malformed_rows_are_counted_not_fatal(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text(
        HEADER + '2024-01-01T10:00:00Z,u1,"two\nlines and a ""quote"", yes",m1,MESG,c1,user,x\n'
        "2024-01-01T10:01:00Z,u1,short,m2\n"
        "2024-01-01T10:02:00Z,u1,long,m3,MESG,c1,user,x,y,z\n"
        "2024-01-01T10:03:00Z,u1,,m4,MESG,c1,user,\n", encoding="utf-8",
    )
    rows = readers.read_messages(spark, str(path))
    by_id = {r.message_id: r for r in rows.collect()}
    assert by_id["m1"].message == 'two\nlines and a "quote", yes'
    assert by_id["m4"].message == "" and by_id["m4"].extra == ""
    assert {i for i, r in by_id.items() if r[readers.MALFORMED]} == {"m2", "m3"}
    assert [r.ingest_seq for r in rows.orderBy("message_id").collect()] == sorted(r.ingest_seq for r in by_id.values())
    counted = stats.preprocess_stats(rows, malformed=readers.MALFORMED).first()
    assert (counted.total_rows, counted.processed_rows, counted.error_rows, counted.filtered_rows) == (4, 2, 2, 0)


def test_counts_come_with_the_write(spark):
    raw = spark.createDataFrame([("1", "c", None), ("", "c", None), ("3", "c", "x")], "message_id string, channel_url string, bad string")
    rows, seen = stats.observed_rows(raw, "bad")
    rows.write.parquet(new_path(spark, "t"))
    assert seen.get == {"total_rows": 3, "processed_rows": 1, "error_rows": 1}


def test_table_without_channel_is_refused(spark):
    path = new_path(spark, "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        readers.load_raw_table(spark, path)


def test_csv_round_trip_keeps_blanks(spark):
    df = spark.createDataFrame([("a", "  two  blanks "), ("b", ""), ("c", 'q"uote,\nline')], "message_id string, message string")
    path = new_path(spark, "t")
    sinks.write_messages(df, path, "csv")
    back = readers.read_messages(spark, path)
    assert {tuple(r) for r in back.select("message_id", "message").collect()} == {tuple(r) for r in df.collect()}


def test_labels_keep_old_values(spark):
    original = spark.createDataFrame([("1", "OLD", "a"), ("2", "OLD", "b"), ("3", None, "c")], "message_id string, case_number string, message string")
    final = spark.createDataFrame(
        [("1", 1, "", ""), ("2", 2, "CASE_0001", ""), ("2", 3, "CASE_0002", "X_Y"), ("2", 4, "", "")],
        "message_id string, ingest_seq long, case_number string, category string",
    ).withColumn("created_time", F.timestamp_seconds(F.col("ingest_seq")))
    rows = {r.message_id: (r.case_number, r.category, r.review) for r in sinks.with_labels(original, final).collect()}
    assert rows == {"1": ("OLD", "", ""), "2": ("CASE_0002", "X_Y", ""), "3": ("", "", "")}


def test_long_cases_continue_in_further_objects(spark, chat):
    messages = chat([("c", i, f"text {i}") for i in range(25)])
    positioned = message_positions(messages)
    bounds = spark.createDataFrame([("c", 0, 1, 25, "all", 0.9, 0)], "channel_url string, case_index long, start_pos long, end_pos long, summary string, confidence double, channel_seq long")
    cases = number_cases(cases_of_boundaries(bounds, positioned))
    path = new_path(spark, "cases")
    sinks.export_cases_json(cases, positioned, path, messages_per_object=10)
    objects = [json.loads(r.value) for r in spark.read.text(path).collect()]
    objects.sort(key=lambda o: o["part"])
    assert [len(o["messages"]) for o in objects] == [10, 10, 5]
    assert [x["message"] for o in objects for x in o["messages"]] == [f"text {i}" for i in range(25)]
    assert objects[0]["participants"] == ["u1"]


def test_ingest_seq_follows_file_names_not_sizes(spark, tmp_path):
    """The file that sorts last is the largest, so Spark packs it first."""
    for name, n in (("a 1.csv", 3), ("b.csv", 5), ("c.csv", 4000)):
        rows = "".join(f"2024-01-01T10:00:00Z,u1,text,{name[0]}{i:05d},MESG,c1,user,x\n" for i in range(n))
        (tmp_path / name).write_text(HEADER + rows, encoding="utf-8")
    for multi_line in (True, False):
        rows = readers.read_messages(spark, str(tmp_path), multi_line).orderBy("ingest_seq").collect()
        assert [r.message_id for r in rows] == sorted(r.message_id for r in rows) and len(rows) == 4008
        assert len({r.ingest_seq for r in rows}) == 4008


@pytest.fixture
def small_splits(spark):
    """Splits of some dozens of bytes, so that records, cells and quotes lie across their borders."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "61b")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def in_one_task(spark, path, names):
    """The same file read by one task of Spark's CSV source."""
    rows = spark.read.csv(str(path), header=True, schema=", ".join(f"`{n}` string" for n in (*names, "_malformed")), multiLine=True, quote='"', escape='"',
                          mode="PERMISSIVE", columnNameOfCorruptRecord="_malformed", enforceSchema=True)
    return [tuple(r) for r in rows.na.fill("", names).collect()]


def cell(r):
    kind = r.random()
    if kind < 0.4:
        return "".join(r.choice(["a", "bc", " ", "é", "😀", "x\"y"]) for _ in range(r.randint(0, 4))).lstrip('"')
    inner = "".join(r.choice(["a", "\n", '""', ",", "\n\n", " word ", '"",""', "é", "\n,\n"]) for _ in range(r.randint(0, 9)))
    return f'"{inner}"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits_equal_one_task(small_splits, tmp_path, end):
    spark, names = small_splits, ["Message ID", "Channel URL", "Message", "n o"]
    folder = tmp_path / "in"
    folder.mkdir()
    for seed in range(3):
        r = random.Random(seed)
        rows = [",".join([f"m{seed}-{i}", cell(r), cell(r), cell(r)][:r.choice([4] * 8 + [2, 3]) ] + ["more"] * (r.random() < 0.1)) for i in range(120)]
        rows[50] = 'big,"' + "line with, comma and \"\"quotes\"\"\n" * 40 + '",z,"end"'  # one cell over many splits
        text = ",".join(names) + "\n" + "\n".join(rows) + "\n" * (seed != 1)
        (folder / f"f{seed}.csv").write_bytes(text.replace("\n", end).encode())
    found = readers.read_messages(spark, str(folder)).orderBy("ingest_seq")
    assert found.columns == ["message_id", "channel_url", "message", "n o", "_malformed", "ingest_seq"]
    got = [tuple(r)[:5] for r in found.collect()]
    want = [row for seed in range(3) for row in in_one_task(spark, folder / f"f{seed}.csv", names)]
    want = [(*row[:4], row[4] and row[4].replace("\r\n", "\n")) for row in want]  # line ends are LF inside records
    assert len(got) == 360 and got == want
    assert len({x.ingest_seq for x in found.collect()}) == 360
    parts = records.placed_lines(spark, str(folder)).select("_file", "_block").distinct().count()
    assert parts > 100


def test_records_of_odd_files(small_splits, tmp_path):
    spark, names = small_splits, ["a", "b"]
    files = {"empty": "a,b\n", "breaks": 'a,b\n\n1,2\n\n\n"3\n\n4",5\n\n', "no_end": 'a,b\n1,"2\n3"', "quoted_header": '"a","b"\n"1","x"\n',
             "wide": "a,b\n" + '"' + "q" * 5_000 + '\n",1\n' + "z" * 3_000 + ",2\n", "cells": "a,b\n" + '"",""\n' * 50 + ",\n" + '" ",x\n'}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        path = tmp_path / f"{name}.csv"
        got = [tuple(r)[:3] for r in readers.read_messages(spark, str(path)).orderBy("ingest_seq").collect()]
        assert got == in_one_task(spark, path, names), name


def test_many_quotes_in_a_line_need_no_stack(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n" + '"' + '""' * 60_000 + '\n"' + "," + "y\n" + "c," * 1 + '"' + '"",' * 60_000 + '"\n', encoding="utf-8")
    rows = readers.read_messages(spark, str(tmp_path / "x.csv")).orderBy("ingest_seq").collect()
    assert [(len(r.a), len(r.b), r._malformed) for r in rows] == [(60_001, 1, None), (1, 120_000, None)]


def test_row_numbers_of_compressed_tables(spark):
    """Far more rows than bytes, and splits of a few row groups: every row has a number of its own, in file order."""
    path = new_path(spark, "t")
    rows = spark.range(600_000, numPartitions=2).selectExpr("cast(id div 300000 as string) as channel_url", "'x' as message", "id")
    rows.write.option("parquet.block.size", "65536").option("parquet.block.row.count.limit", "20000").parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = readers.load_raw_table(spark, path)
        seen = found.agg(F.countDistinct("ingest_seq"), F.corr("ingest_seq", "id"), F.min("ingest_seq")).first()
        assert seen[0] == 600_000 and seen[2] == 0
        one = found.where("channel_url = '0'").agg(F.max("ingest_seq"), F.sum(F.abs(F.col("ingest_seq") - F.col("id")))).first()
        assert tuple(one) == (299_999, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_labels_of_an_id_in_two_channels(spark):
    kinds = "channel_url string, message_id string, case_number string, category string, created_time timestamp, ingest_seq long"
    final = spark.createDataFrame([("a", "1", "CASE_0001", "x", None, 0), ("b", "1", "CASE_0002", "y", None, 1)], kinds).withColumn(
        "created_time", F.timestamp_seconds("ingest_seq"))
    original = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), (None, "1")], "channel_url string, message_id string")
    labels = {r.channel_url: r.case_number for r in sinks.with_labels(original, final).collect()}
    assert labels == {"a": "CASE_0001", "b": "CASE_0002", "c": "", None: ""}
    alone = sinks.with_labels(original.select("message_id"), final).collect()
    assert [r.case_number for r in alone] == ["CASE_0002"] * 4


def test_small_splits_share_tasks(spark, tmp_path):
    """Every task reports to the driver, so splits of 200 bytes do not become tasks each; records and order stay."""
    path = tmp_path / "export.csv"
    lines = [f'2024-01-01T10:00:00Z,u1,"text {i}{chr(10) * (i % 3)}""",m{i},MESG,c1,user,x\n' for i in range(2000)]
    path.write_text(HEADER + "".join(lines), encoding="utf-8")
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in settings}
    context = spark.sparkContext
    context.setJobGroup("small splits", "")
    try:
        for k in settings:
            spark.conf.set(k, "200")
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 300
        rows = readers.read_messages(spark, str(path)).orderBy("ingest_seq").collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r.message_id, r.message) for r in rows] == [(f"m{i}", f'text {i}{chr(10) * (i % 3)}"') for i in range(2000)]
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("small splits") for s in tracker.getJobInfo(j).stageIds}
    assert max(info.numTasks for info in map(tracker.getStageInfo, stages) if info) <= 10


def test_a_large_source_in_order_is_many_files(spark, monkeypatch):
    """Rows of a file are sorted by one task, and met by the rank of their file where they are read."""
    sf = "/root/testdata/sf0.001"
    usual = tables_and_text.load_raw_table_numbered(spark, sf)
    monkeypatch.setattr(tables_and_text, "ROWS_PER_FILE", 1000)
    rows = tables_and_text.load_raw_table_numbered(spark, sf)
    assert len(usual.inputFiles()) < 6 <= len(rows.inputFiles())
    assert "hashpartitioning(_file" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, usual.collect()))
