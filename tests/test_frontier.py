"""The model asked window by window, against the same loop in plain Python for each channel."""

import json
import random

from convocases.plans import frontier, pipeline, requests


def model():
    """What a model says to a window, or None. Made inside a function, so that it travels to the workers by value."""
    def reply_of(first, last, truth, broken):
        if broken(first):
            return None
        return [(max(s, first), min(e, last)) for s, e in truth if s <= last and e >= first]
    return reply_of


reply_of = model()


def by_hand(n, truth, size, broken):
    at, forced, out = 1, False, []
    while at <= n:
        last = min(n, at + size - 1)
        ranges = reply_of(at, last, truth, broken)
        ranges = [(at, last)] if ranges is None else ranges
        open_ = min((s for s, e in ranges if e == last), default=None)
        full = last < n and open_ == at
        taken = ranges if last == n or full else [r for r in ranges if r[1] < last]
        out += [(s, e, full and e == last, forced and s == at) for s, e in taken]
        ends = max((e for _, e in ranges), default=last)
        at, forced = (last + 1 if last == n or full else open_ or ends + 1), full
    return out


def test_windows(spark, chat):
    r = random.Random(3)
    truths, rows = {}, []
    for i in range(12):
        n = r.randint(1, 60)
        cuts = sorted(r.sample(range(2, n + 1), min(n - 1, r.randint(0, 9)))) if n > 1 else []
        truth = list(zip([1, *cuts], [*(c - 1 for c in cuts), n]))
        truths[f"ch{i}"] = (n, [t for t in truth if i % 3 or r.random() < 0.8])  # some leave gaps
        rows += [(f"ch{i}", m, "x") for m in range(n)]
    broken = lambda channel: lambda first: (hash_of(channel) + first) % 5 == 0
    hash_of = lambda channel: int(channel[2:])

    say = model()

    def fn(batch):
        out = []
        for request_id, channel, first, last in zip(batch["request_id"], batch["channel_url"], batch["first_pos"], batch["last_pos"]):
            ranges = say(first, last, truths[channel][1], broken(channel))
            body = [{"start_message": int(s), "end_message": int(e), "summary": "s", "confidence": 0.5} for s, e in ranges or []]
            out.append("nothing" if ranges is None else json.dumps({"complete_cases": body}))
        return batch[["request_id"]].assign(content=out)

    asked = []

    def answer(table):
        asked.append(table.count())
        assert max(p.prompt.count("<message id=") for p in table.select("prompt").collect()) <= 9
        return requests.map_requests(table, fn, 2)

    messages = chat(rows)
    found = frontier.segment_by_queue(messages.repartition(5), answer, size=9)
    got = {}
    for c in found.orderBy("channel_url", "case_index").collect():
        got.setdefault(c.channel_url, []).append((c.start_pos, c.end_pos, c.forced_ending, c.forced_starting))
        assert c.case_index == len(got[c.channel_url]) - 1
    want = {ch: by_hand(n, truth, 9, broken(ch)) for ch, (n, truth) in truths.items()}
    assert got == {ch: w for ch, w in want.items() if w}
    assert len(asked) <= max(n for n, _ in truths.values()) and asked[0] == 12 and asked[-1] >= 1
    cases = pipeline.segment_with_boundaries(messages, found, pipeline.message_positions(messages)).cases
    assert cases.count() == sum(map(len, want.values())) and cases.where("forced_ending").count() == sum(x[2] for w in want.values() for x in w)


def test_nothing_to_ask(spark, chat):
    assert frontier.segment_by_queue(chat([("a", 0, "x")]).where("false"), lambda asked: None).collect() == []
