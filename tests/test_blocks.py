"""Ordered scans and spread joins give what one window or one join gives, however the groups are cut."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from convocases.operators import blocks
from convocases.operators.blocks import Step

STEPS = dict(
    nth=Step("row_number"), prev=Step("lag", F.col), last=Step("last", F.col), total=Step("sum", F.col),
    top=Step("max", F.col), n=Step("count"), low=Step("least", F.col), all=Step("total", F.col),
)


def steps():
    return {k: Step(s.kind, s.value("v") if s.value else None) for k, s in STEPS.items()}


def brute(rows):
    """The same columns by hand, rows as (key, place, value)."""
    out = []
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        values = [r[2] for r in group if r[2] is not None]
        for i, (_, place, v) in enumerate(group):
            before = [r[2] for r in group[:i] if r[2] is not None]
            upto = before + ([v] if v is not None else [])
            out.append((
                key, place, v, i + 1, group[i - 1][2] if i else None, before[-1] if before else None,
                sum(upto) if upto else None, max(upto) if upto else None, len(group),
                min(values) if values else None, sum(values) if values else None,
            ))
    return sorted(out, key=str)


def scanned(spark, rows, rows_per_block):
    df = spark.createDataFrame(rows, "k string, place long, v long").repartition(5)
    o = blocks.scan(blocks.in_blocks(df, ["k"], ["place"], rows_per_block=rows_per_block), **steps())
    out = blocks.finish(o).select("k", "place", "v", *STEPS)
    return sorted([tuple(r) for r in out.collect()], key=str), o.split


def make_rows(sizes, seed=1):
    rng = random.Random(seed)
    return [
        (key, i, rng.choice([None, rng.randint(-50, 50)])) for key, n in sizes.items() for i in range(n)
    ]


@pytest.mark.parametrize("rows_per_block", [1, 3, 10, 100, 10**6])
def test_scan_equals_brute_force(spark, rows_per_block):
    rows = make_rows({"hot": 120, "b": 40, "c": 40, "d": 1, "e": 2})
    got, split = scanned(spark, rows, rows_per_block)
    assert got == brute(rows)
    assert split == (rows_per_block < 120)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.dictionaries(st.sampled_from("abcd"), st.integers(1, 25), min_size=1), per=st.integers(1, 9), seed=st.integers(0, 99))
def test_scan_property(spark, sizes, per, seed):
    rows = make_rows(sizes, seed)
    assert scanned(spark, rows, per)[0] == brute(rows)


def test_sampled_cuts_bound_the_blocks(spark):
    """One key holds a third of all rows: no block is far above the wanted size."""
    df = spark.range(60_000).selectExpr("case when id % 3 = 0 then 'hot' else 'k' || id % 500 end as k", "id as place")
    o = blocks.in_blocks(df, ["k"], ["place"], rows_per_block=1_000)
    sizes = o.rows.groupBy("k", blocks.BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] < 2_000
    assert sizes.where("k = 'hot'").count() > 10
    ranked = blocks.finish(blocks.scan(o, nth=Step("row_number")))
    assert ranked.where("k = 'hot' and nth <> place div 3 + 1").count() == 0


def test_global_order_is_dense(spark):
    df = spark.range(5_000).selectExpr("xxhash64(id) as place", "id")
    o = blocks.in_blocks(df, [], ["place"], rows_per_block=200)
    rows = blocks.finish(blocks.scan(o, nth=Step("row_number"))).orderBy("place").select("nth").collect()
    assert o.split and [r[0] for r in rows] == list(range(1, 5_001))


def test_equal_places_lose_no_row(spark):
    """Rows of one key at the very same place cannot be cut apart, but none is lost."""
    df = spark.range(300).selectExpr("'a' as k", "cast(1 as bigint) as place", "cast(1 as bigint) as v")
    o = blocks.scan(blocks.in_blocks(df, ["k"], ["place"], rows_per_block=10), nth=Step("row_number"))
    assert sorted(r.nth for r in blocks.finish(o).collect()) == list(range(1, 301))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_spread_join_equals_join(spark, how):
    left = spark.range(900).selectExpr("case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else 'k' || id % 40 end as k", "id")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "k string, w int")
    plain = left.join(right, ["k"], how)
    spread = blocks.join_spread(left, right, ["k"], how, spread=["id"], hot_rows=50)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_keys_are_dealt_out(spark):
    left = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', 'k' || id) as k", "id")
    hot = blocks.hot_keys(left, ["k"], hot_rows=50)
    assert [(r["k"], r["_shares"]) for r in hot] == [("hot", 7)]


def test_a_null_group_is_cut_and_counted(spark):
    rows = spark.range(2000).selectExpr("if(id % 4 = 0, 'a', null) as g", "id as t", "id as v")
    o = blocks.in_blocks(rows, ["g"], ["t"], rows_per_block=64)
    assert o.null_keys and o.rows.where("g is null").select(blocks.BLOCK).distinct().count() > 10
    found = blocks.finish(blocks.scan(o, n=Step("row_number"), s=Step("sum", F.col("v")))).orderBy("t").collect()
    seen = {None: (0, 0), "a": (0, 0)}
    for r in found:
        n, s = seen[r.g]
        seen[r.g] = (n + 1, s + r.v)
        assert (r.n, r.s) == seen[r.g]


def test_hot_join_on_rows_with_a_map(spark):
    left = spark.range(3000).selectExpr("if(id < 2500, 'hot', string(id)) as k", "id", "map('a', string(id)) as m")
    right = spark.createDataFrame([("hot",), ("2999",)], "k string")
    assert blocks.join_spread(left, right, ["k"], "left_semi", hot_rows=200).count() == 2501


def test_many_cuts_are_searched_in_short_lists(spark, monkeypatch):
    """A row carries no list of all cuts of its group: 300 of them are found by lists of three."""
    monkeypatch.setattr(blocks, "FAN", 4)
    longest = []
    upto = blocks.cuts_upto
    monkeypatch.setattr(blocks, "cuts_upto", lambda bounds, here, n: longest.append(n) or upto(bounds, here, n))
    rows = spark.range(1300).selectExpr("case when id < 1200 then null when id % 2 = 0 then 'a' else 'b' || id end as g", "id as t")
    o = blocks.in_blocks(rows, ["g"], ["t"], rows_per_block=4)
    assert len(longest) == 5 and max(longest) == 3
    sizes = o.rows.where(blocks.SPLIT).groupBy("g", blocks.BLOCK).count().collect()
    assert {r["count"] for r in sizes} <= {1, 2, 3, 4} and len(sizes) == 300 + 13
    found = blocks.finish(blocks.scan(o, n=Step("row_number")))
    assert found.where("g is null and n <> t + 1 or g = 'a' and n <> (t - 1198) div 2").count() == 0


def test_too_many_cuts_cost_no_further_pass(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MAX_CUTS", 10)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(3000).selectExpr("'a' as g", "id as t").mapInPandas(count, "g string, t long")
    cuts = blocks.find_cuts(rows, ["g"], ["t"], rows_per_block=4)
    assert 5 <= len(cuts.rows) <= 10
    assert read.value == 6000  # counted and sampled once, however many cuts the rows per block ask for


@pytest.mark.parametrize("rows_per_block", [1, 3, 10**6])
def test_lead_looks_over_borders(spark, rows_per_block):
    rows = make_rows({"hot": 50, "b": 7, "c": 1})
    df = spark.createDataFrame(rows, "k string, place long, v long").repartition(5)
    o = blocks.scan(blocks.in_blocks(df, ["k"], ["place"], rows_per_block=rows_per_block), after=Step("lead", F.col("v")))
    got = {(r.k, r.place): r.after for r in blocks.finish(o).select("k", "place", "after").collect()}
    values = {(k, place): v for k, place, v in rows}
    assert got == {(k, place): values.get((k, place + 1)) for k, place in values} and o.split == (rows_per_block < 50)
