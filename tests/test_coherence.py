"""Depth of coherence against plain Python, with groups cut into blocks."""

import math
import random

from convocases.operators import blocks, context, segment


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def by_hand(vectors):
    values = [None] + [None if a is None or b is None else round(cosine(a, b), 6) for a, b in zip(vectors, vectors[1:])]

    def climb(i, step):
        best = values[i]
        at = i + step
        while 0 <= at < len(values):
            if values[at] is not None:
                if values[at] < best:
                    break
                best = values[at]
            at += step
        return best
    return [None if v is None else round(climb(i, -1) + climb(i, 1) - 2 * v, 6) for i, v in enumerate(values)]


def test_depth(spark, monkeypatch):
    r = random.Random(5)
    groups = {g: [None if r.random() < 0.1 else [r.uniform(0.1, 1) + (4 if (i // 6) % 2 == d else 0) for d in range(2)] for i in range(n)]
              for g, n in (("a", 40), ("b", 1), ("c", 2), ("d", 25), (None, 9))}
    groups["same"] = [[1.0, 2.0]] * 6
    rows = [(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g string, i int, embedding array<double>")
    want = {(g, i): d for g, vs in groups.items() for i, d in enumerate(by_hand(vs))}

    def found(**options):
        got = {(x.g, x.i): x.depth for x in context.coherence_depth(df, ["g"], ["i"], **options).collect()}
        assert got.keys() == want.keys()
        assert [(k, got[k], want[k]) for k in want if (got[k] is None) != (want[k] is None) or abs((got[k] or 0) - (want[k] or 0)) > 3e-6] == []

    found()
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 7)
    found(rows_per_block=7)
    assert sum(d is not None and d > 0.5 for d in want.values()) > 5


def test_depth_is_a_rule(spark, chat):
    messages = chat([("a", i, "order #1" if i in (3, 4) else "x") for i in range(6)])
    deep = messages.selectExpr("*", "case when ingest_seq in (2, 4) then 0.9D when ingest_seq = 5 then 0.3D end as depth")
    rows = segment.segment_by_rules(deep, rules=segment.Rules(depth=0.5)).orderBy("pos").collect()
    assert [x.rule for x in rows] == [1, None, 6, None, None, None]  # not inside the same order
    assert [x.rule for x in segment.segment_by_rules(deep).orderBy("pos").collect()] == [1] + [None] * 5
