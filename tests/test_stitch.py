"""Stitched cases against a part-by-part version in plain Python."""

import json
import random

from convocases.operators import blocks, stitch
from convocases.operators.replies import join_replies
from convocases.plans import pipeline, requests
from convocases.sources.scratch import checkpointed

ASKED = ("request_id string, channel_url string, part int, first_pos long, last_pos long, channel_messages long, channel_seq long,"
         " case_truncated boolean, overlap int")


def by_hand(parts, replies):
    """Cases (start, end, summary, confidence, forced_ending, forced_starting) of one channel, in order.

    parts: (first, last); replies: list of (start, end, summary, confidence), or None without a usable reply.
    """
    n = len(parts)
    own, blind = [[f, t] for f, t in parts], [False] * n
    for p in range(1, n):
        first, before = parts[p][0], parts[p - 1][1]
        blind[p] = first > before
        own[p - 1][1] = before if blind[p] else (first + before) // 2
        own[p][0] = own[p - 1][1] + 1
    total, ranges = parts[-1][1], []
    for (f, t), reply in zip(parts, replies):
        given = [(f, t, "fallback", 0.1)] if reply is None else reply
        given = [(i, s, e, x, c) for i, (s, e, x, c) in enumerate(given) if 1 <= s <= e <= total]
        ranges.append([(i, max(s, f), min(e, t), x, c) for i, s, e, x, c in given if max(s, f) <= min(e, t)])
    pieces = {(p, i): [max(s, own[p][0]), min(e, own[p][1]), x, c] for p in range(n) for i, s, e, x, c in ranges[p] if e >= own[p][0] and s <= own[p][1]}
    group = {k: k for k in pieces}
    forced = set()
    for p in range(1, n):
        right = [r for r in ranges[p - 1] if r[1] <= own[p - 1][1] <= r[2]]
        left = [r for r in ranges[p] if r[1] <= own[p][0] <= r[2]]
        if not right or not left:
            continue
        a, b = max(right), max(left)
        lost = (replies[p - 1] is None, replies[p] is None)
        meet = (a[2] > own[p - 1][1] or a[2] == parts[p - 1][1]) and b[1] < own[p][0] and not blind[p]
        if all(lost) or (not any(lost) and meet):
            group[p, b[0]] = group[p - 1, a[0]]
        elif blind[p] or any(lost):
            forced.add((p, b[0]))
    cases = {}
    for k in sorted(pieces):
        cases.setdefault(group[k], []).append(k)
    rows = []
    for ks in sorted(cases.values()):
        s, e = min(pieces[k][0] for k in ks), max(pieces[k][1] for k in ks)
        best = max(ks, key=lambda k: (pieces[k][1] - pieces[k][0], -k[0]))
        rows.append([s, e, *pieces[best][2:], False, ks[0] in forced])
    for r in rows:
        r[4] = any(q[5] and q[0] == r[1] + 1 for q in rows)
    return [tuple(r) for r in rows]


def some_channel(r):
    """Parts that overlap or not, and replies that agree with a truth, disagree, leave gaps, or are of no use."""
    n = r.randint(1, 40)
    cuts = sorted(r.sample(range(2, n + 1), min(n - 1, r.randint(0, 5)))) if n > 1 else []
    truth = list(zip([1, *cuts], [*(c - 1 for c in cuts), n]))
    parts, at = [], 1
    while True:
        last = min(n, at + r.randint(2, 8))
        parts.append((at, last))
        if last == n:
            break
        at = max(at + 1, last + 1 - r.choice([0, 1, 2, 3]))
    kind, replies = r.choice(["true", "loose"]), []
    for f, t in parts:
        if kind == "loose" and r.random() < 0.3:
            replies.append(None)
            continue
        seen = [(max(s, f), min(e, t), f"c{s}", 0.5) for s, e in truth if s <= t and e >= f]
        if kind == "loose":
            seen = [(max(1, s + r.choice([0, 0, 0, 1, -1])), e + r.choice([0, 0, 0, 1]), x, r.choice([0.5, 0.7])) for s, e, x, _ in seen if r.random() < 0.9]
        replies.append(seen)
    return truth, kind, parts, replies


def test_random_channels(spark, monkeypatch):
    r = random.Random(2)
    channels = [some_channel(r) for _ in range(250)]
    asked, answers = [], []
    for i, (_, _, parts, replies) in enumerate(channels):
        for p, ((f, t), reply) in enumerate(zip(parts, replies)):
            asked.append((f"{i}:{p}", f"ch{i}", p, f, t, parts[-1][1], i, False, 1))
            body = [{"start_message": s, "end_message": e, "summary": x, "confidence": c} for s, e, x, c in reply or []]
            answers.append((f"{i}:{p}", "no json" if reply is None else json.dumps({"complete_cases": body}), None))
    joined = join_replies(spark.createDataFrame(asked, ASKED), spark.createDataFrame(answers, "request_id string, content string, error string"))
    joined = checkpointed(joined)

    def found():
        out = {}
        for c in stitch.stitched(joined).orderBy("channel_url", "case_index").collect():
            summary = "fallback" if c.confidence == 0.1 else c.summary
            out.setdefault(c.channel_url, []).append((c.start_pos, c.end_pos, summary, c.confidence, c.forced_ending, c.forced_starting))
            assert c.case_index == len(out[c.channel_url]) - 1
        return out

    want = {f"ch{i}": by_hand(parts, replies) for i, (_, _, parts, replies) in enumerate(channels)}
    got = found()
    assert got == {k: v for k, v in want.items() if v}
    for i, (truth, kind, parts, _) in enumerate(channels):
        if kind == "true" and all(b[0] <= a[1] for a, b in zip(parts, parts[1:])):
            assert [c[:2] for c in got[f"ch{i}"]] == truth
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 3)
    assert found() == got


def test_overlapping_requests(spark, chat):
    messages = chat([("a", i, "y" * 100) for i in range(60)] + [("b", 0, "z"), ("c", 0, "w" * 3_000), ("c", 1, "w" * 3_000), ("c", 2, "v")])
    rows = requests.segmentation_requests(messages, budget=400, overlap=120).orderBy("channel_url", "part").collect()
    parts = [r for r in rows if r.channel_url == "a"]
    assert parts[0].first_pos == 1 and parts[-1].last_pos == 60 and all(y.first_pos <= x.last_pos for x, y in zip(parts, parts[1:]))
    assert all(y.first_pos > x.first_pos and y.last_pos > x.last_pos for x, y in zip(parts, parts[1:]))
    assert sum(p.prompt.count("<message id=") for p in parts) == sum(p.last_pos - p.first_pos + 1 for p in parts)
    assert [(r.part, r.first_pos, r.last_pos) for r in rows if r.channel_url == "b"] == [(0, 1, 1)]
    covered = sorted(p for r in rows if r.channel_url == "c" for p in range(r.first_pos, r.last_pos + 1))
    assert set(covered) == {1, 2, 3}
    empty = spark.createDataFrame([], requests.REPLY_SCHEMA)
    asked = requests.segmentation_requests(messages, budget=400, overlap=120)
    cases = pipeline.segment_with_replies(messages, empty, requests=asked).cases.orderBy("channel_url").collect()
    assert [(c.channel_url, c.start_pos, c.end_pos, c.confidence) for c in cases] == [("a", 1, 60, 0.3), ("b", 1, 1, 0.3), ("c", 1, 3, 0.3)]


def test_stitching_broadcasts_nothing(spark):
    """Parts and ranges grow with the messages, and their files look small."""
    rows = spark.range(400).selectExpr(
        "'c' || id div 4 as channel_url", "cast(id % 4 as int) as part", "(id % 4) * 5 + 1 as first_pos", "(id % 4) * 5 + 7 as last_pos",
        "22L as channel_messages", "id div 4 as channel_seq", "false as case_truncated", "'segment:' || id as request_id")
    content = """format_string('{"complete_cases": [{"start_message": %d, "end_message": %d, "summary": "s", "confidence": 1}]}', first_pos, last_pos)"""
    answers = rows.selectExpr("request_id", f"{content} as content", "cast(null as string) as error")
    joined = join_replies(checkpointed(rows), checkpointed(answers))
    found = stitch.stitched(checkpointed(joined))
    assert found.where("start_pos = 1 and end_pos = 22").count() == found.count() == 100
    for df in (joined, found):
        df.collect()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_cut_channels_stitch_alike(spark):
    """Channels of many parts are cut into blocks, whose rows read on over the borders."""
    r = random.Random(5)
    channels = [some_channel(r) for _ in range(60)]
    asked, answers = [], []
    for i, (_, _, parts, replies) in enumerate(channels):
        for p, ((f, t), reply) in enumerate(zip(parts, replies)):
            asked.append((f"{i}:{p}", f"ch{i}", p, f, t, parts[-1][1], i, False, 1))
            body = [{"start_message": s, "end_message": e, "summary": x, "confidence": c} for s, e, x, c in reply or []]
            answers.append((f"{i}:{p}", "no json" if reply is None else json.dumps({"complete_cases": body}), None))
    joined = checkpointed(join_replies(spark.createDataFrame(asked, ASKED), spark.createDataFrame(answers, "request_id string, content string, error string")))
    plain = blocks.find_cuts(joined, ["channel_url"], ["part"])
    cut = blocks.find_cuts(joined, ["channel_url"], ["part"], 3)
    assert not plain.rows and len(cut.rows) > 20
    whole, parted = (sorted(map(tuple, stitch.stitched(joined, cuts).collect()), key=str) for cuts in (plain, cut))
    assert whole == parted and len(whole) > 100


def tables_read(df):
    """The files that a plan reads, once for each time it reads them, and its exchanges."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("FileScan"), df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange ")


def test_parts_move_once(spark):
    """Replies are read once, and a row for each part goes by channel once: what grows with the messages is not shuffled over and over."""
    rows = spark.range(400).selectExpr(
        "'c' || id div 4 as channel_url", "cast(id % 4 as int) as part", "(id % 4) * 5 + 1 as first_pos", "(id % 4) * 5 + 7 as last_pos",
        "22L as channel_messages", "id div 4 as channel_seq", "false as case_truncated", "'segment:' || id as request_id")
    content = """format_string('{"complete_cases": [{"start_message": %d, "end_message": %d, "summary": "s", "confidence": 1}]}', first_pos, last_pos)"""
    answers = rows.selectExpr("request_id", f"{content} as content", "cast(null as string) as error")
    asked = checkpointed(rows)
    found = stitch.stitched(join_replies(asked, checkpointed(answers)), blocks.find_cuts(asked, ["channel_url"], ["part"]))
    assert tables_read(found) == (2, 3)  # requests and replies by request, then the parts by channel
    assert found.where("start_pos = 1 and end_pos = 22").count() == found.count() == 100
