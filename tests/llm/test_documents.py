"""Operators on documents against their brute-force versions, on odd rows and on the smallest tables."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from convocases.llm import bpe, exact, minhash, packing, pii, quality, suffixes, toxicity  # noqa: E402
from convocases.llm.queries import QUERIES, word_vocabulary  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, keep_id string, found string,"
          " spans string, _row int, ids string, score string, component_id int, uid int, offset int")


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, near copies, shared passages, and columns with clashing names."""
    long, passage = words(1, 30_000), words(2, 60)
    near = words(3, 200).split()
    texts = [None, "", " \n\t", "a b", "A  b", "ab", long, long + " end", passage, words(4, 40) + " " + passage + " " + words(5, 40),
             " ".join(near), " ".join(near[:199] + ["other"]), " ".join(["one", *near]), "x" * 5_000, "ÄÖ ǘ 日本 😀 <|endoftext|> it's",
             "mail me: a.b@c-d.example.org, b@c.d_e@f.g 1.2.3.400 10.0.0.255, 4111 1111 1111 1111, 4111111111111112 +49 (30) 123-456 \x00 +1 2",
             "IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789, tel 555-123-4567", "7" * 3_000, "l1\nl1\nl2\n\n \n" + "w " * 100, "\r\n\x0b\x0c"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (100, texts[10]), (101, texts[10]), (-5, "a b"), (102, passage)]
    full = [(i, t, None, None, None if t is None else len(t), True, "k", "f", "s", 1, "i", "s", 3, 4, 5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA), rows


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["odd", "documents"])
def both(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(both):
    docs, rows = both
    found = sorted(tuple(r)[:5] for r in exact.exact_duplicates(docs).collect())
    assert found == sorted(brute.exact(rows))


def test_exact_drops_copies_and_repeated_rows(odd):
    docs, rows = odd
    left = exact.drop_exact_duplicates(docs)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == docs.columns
    assert sorted(ids) == sorted({b[1] for b in brute.exact(rows)})


def test_exact_null_id(spark):
    docs = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b c"), (4, "bc")], "doc_id long, text string")
    found = {tuple(r)[:4] for r in exact.exact_duplicates(docs).collect()}
    assert found == {(None, 3, 2, False), (3, 3, 2, True), (None, None, 2, True), (4, None, 2, False)}


def test_exact_drops_by_content_where_ids_repeat(spark):
    rows = [(None, "a"), (None, "b c"), (None, "bc"), (None, "b  c"), (None, None), (None, ""), (7, "one"), (7, "two"), (7, "tw o"),
            (8, "t w o"), (9, "three"), (9, "x y"), (3, "x y"), (5, "same"), (5, "same"), (5, "s a m e")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, kept int")
    left = exact.drop_exact_duplicates(docs)
    found = [(r.doc_id, (r.text or "").replace(" ", ""), len(r.text or "")) for r in left.collect()]
    assert left.dtypes == docs.dtypes
    assert sorted(found, key=str) == sorted([(None, "a", 1), (None, "bc", 4), (None, "", 0), (7, "one", 3), (8, "two", 5), (9, "three", 5),
                                             (3, "xy", 3), (5, "same", 7)], key=str)


def test_byte_pairs_equal_the_library(both):
    from tokenizers import Tokenizer

    docs, rows = both
    library = Tokenizer.from_file(word_vocabulary())
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    found = [(r.doc_id, bytes(r.ids), r.decoded) for r in bpe.decode(bpe.encode(docs, word_vocabulary()), word_vocabulary()).collect()]
    assert sorted(found) == sorted(want)


def test_byte_pairs_on_random_characters():
    from tokenizers import Tokenizer

    library, own, r = Tokenizer.from_file(word_vocabulary()), bpe.BytePairs(word_vocabulary()), random.Random(5)
    letters = "ab cde'st \t\n\r\x0b\x0c\x1c\x1f\x85\xa0ÀÉéß İıΣσςǅK　\u0301\u0300가각中文日本٣²_-.,!?012😀\u200d\ufeff\x00\x7f"
    texts = ["".join(r.choice([*letters, "<|endoftext|>", "<|"]) for _ in range(r.randint(0, 50))) for _ in range(3_000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_byte_pairs_where_white_space_balances():
    from tokenizers import Tokenizer

    library, spaces = Tokenizer.from_file(word_vocabulary()), "\xa0\u3000\u2003\x85\u2028\t"
    one = ["é1", "\xa0", "x\xa0y", "é2"]
    assert len(library.normalizer.normalize_str(" ".join(one)).split(" ")) == len(one)
    for chunks in (one, ["é1", *spaces[:5], *(f"x{s}ß" for s in spaces[:5]), "é2"], ["\u3000é", "é\u3000", "ü\xa0\xa0ä", "\u3000\u3000", "ö"]):
        found = bpe.BytePairs(word_vocabulary()).learn(chunks)
        assert {c: np.frombuffer(found[c], "<u4").tolist() for c in chunks} == {c: library.encode(c, add_special_tokens=False).ids for c in chunks}


def test_byte_pairs_white_space_is_all_that_the_library_folds():
    from tokenizers import Tokenizer

    fold = Tokenizer.from_file(word_vocabulary()).normalizer.normalize_str
    assert not [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff" and not bpe._SPACE.search(c) and " " in fold(f"x{c}y")]


def test_byte_pairs_leftmost_rounds_agree():
    own, other = bpe.BytePairs(word_vocabulary()), bpe.BytePairs(word_vocabulary())
    assert own.whole_rounds
    other.whole_rounds = False
    texts = ["a" * 50, "hahahahaha", words(9, 200)]
    assert list(own.encode(texts)) == list(other.encode(texts))


def test_personal_data(both):
    docs, rows = both
    found = sorted(tuple(r)[:6] for r in pii.personal_data(docs).collect())
    assert found == sorted((doc_id, *brute.personal_data(text)) for doc_id, text in rows)


def test_personal_data_beyond_the_base(odd):
    docs, rows = odd
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    text = dict(rows)[16]
    parts = dict((x.split(":")[0], text[int(x.split(":")[1]):int(x.split(":")[2])]) for x in spans[16].split(","))
    assert parts == {"iban": "DE89 3704 0044 0532 0130 00", "ssn": "123-45-6789", "local_phone": "555-123-4567"}


def test_redaction(odd):
    docs, rows = odd
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    found = {r.doc_id: r for r in clean.collect()}
    assert found[15].text.startswith("mail me: [email], [email][email] 1.2.3.400 [ip], [card], 4111111111111112 [phone]")
    assert found[15].n_chars == len(found[15].text)
    assert found[16].text == "IBAN [iban], ssn [ssn], tel [local_phone]"
    assert found[0].text is None and found[6].text == dict(rows)[6]


def test_redaction_merges_overlaps(spark):
    docs = spark.createDataFrame([(1, "x +4111111111111111 y")], "doc_id long, text string")
    assert pii.redact(docs).first().text == "x +[card] y"


def test_quality_measures(both):
    docs, rows = both
    found = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in quality.quality_verdicts(docs).collect())
    assert found == sorted((doc_id, *brute.measures(text)) for doc_id, text in rows)


def test_quality_weights():
    good, bad = (1, 1, 1, 1, 1, 1, 1), (-1, 1, 1, 1, 1, 1, 1)
    bias, weights = quality.fit_votes([(good, 950), (bad, 30), ((-1, -1, 1, 1, 0, 1, 1), 20)])
    odds = lambda votes: bias + sum(w[0] if v == 1 else w[1] if v == -1 else 0 for v, w in zip(votes, weights))
    assert odds(good) > 0 > odds(bad)
    assert quality.fit_votes([]) == quality.fit_votes([])


def test_quality_verdicts_against_plain_em(both):
    docs, rows = both
    want = brute.quality(rows, quality.RULES, quality.START, quality.HOLD, quality.GOOD_SHARE)
    found = [(r.doc_id, r.kept, r.p_good) for r in quality.quality_verdicts(docs).collect()]
    rounded = lambda all_rows: sorted((str(d), k, round(p, 6)) for d, k, p in all_rows)
    assert rounded(found) == rounded(want)


@pytest.mark.parametrize("share", [0.001, 0.01, 0.03, 0.1])
def test_a_weak_rule_is_outvoted(share):
    """At any share and size: one bad vote of a weak rule does not reject a text, one of a strong rule or two weak ones do."""
    count = len(quality.RULES)
    for total in (1_000, 100_000):
        for r, kind in enumerate(quality.KINDS):
            lone = tuple(-1 if i == r else 1 for i in range(count))
            bias, weights = quality.fit_votes([((1,) * count, round(total * (1 - share))), (lone, round(total * share))])
            odds = lambda votes: bias + sum(w[0] if v == 1 else w[1] if v == -1 else 0 for v, w in zip(votes, weights))  # noqa: E731, B023
            assert odds((1,) * count) > 0 and (odds(lone) > 0) == (kind == "weak")
            weak = [i for i, k in enumerate(quality.KINDS) if k == "weak"]
            assert all(odds(tuple(-1 if i in (a, b) else 1 for i in range(count))) < 0 for a in weak for b in weak if a < b)


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = quality.quality_verdicts(docs).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    count = {(r.quality, r.kept): r["count"] for r in seen}
    assert count[1, True] > 0.9 * (count[1, True] + count.get((1, False), 0))
    assert count[0, False] > 0.8 * (count[0, False] + count.get((0, True), 0))


def test_repeated_strings(both):
    docs, rows = both
    want = brute.repeated_bytes(rows)
    # Rows that repeat an id and its text repeat each other; the brute-force version sees both of them.
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixes.drop_repeats(docs).collect()]
    assert sorted(found) == sorted((doc_id, *want[doc_id]) for doc_id, _ in rows)


@pytest.mark.parametrize("hot", [0, 2])
def test_repeated_strings_with_hot_keys(documents, hot):
    docs, rows = documents
    want = brute.repeated_bytes(rows)
    assert {r.doc_id: r.n_removed for r in suffixes.drop_repeats(docs, hot=hot).collect()} == {d: w[1] for d, w in want.items()}


@pytest.mark.parametrize("hot", [0, 3])
def test_repeated_strings_around_a_common_line(spark, hot):
    """One line in every text, with more of its neighbourhood shared by some: hot keys are dealt out at every width."""
    r, line = random.Random(11), words(21, 30)
    texts = []
    for i in range(60):
        before, after = words(100 + i % 7, 40)[-r.choice([0, 3, 20, 90]):], words(200 + i % 5, 40)[:r.choice([0, 5, 30, 100])]
        texts.append(words(300 + i, 30) + " " + before + line + after + words(400 + i, 30))
    texts += [line, "x" + line, "y" + line + "z", line * 3]
    want = brute.repeated_bytes(list(enumerate(texts)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for widths in ((40, 8, 1), (16,), (1,)):
        assert {d.doc_id: d.n_removed for d in suffixes.drop_repeats(docs, hot=hot, widths=widths).collect()} == {d: w[1] for d, w in want.items()}


def test_repeated_strings_without_ids(spark):
    """Texts without an id, or with the same, don't mix, whatever their lengths."""
    passage = words(31, 60)
    texts = [passage + " one", "two " + passage, "short", words(32, 90), None, "", passage]
    want = brute.repeated_bytes(list(enumerate(texts)))
    for doc_id in (None, 7):
        docs = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id long, text string")
        found = suffixes.drop_repeats(docs).collect()
        assert sorted((d.n_bytes, d.n_removed) for d in found) == sorted(w[:2] for w in want.values())
        assert {d.doc_id for d in found} == {doc_id}


def test_deep_shallow_order():
    r, rng = random.Random(3), np.random.default_rng(1)
    for _ in range(60):
        size, shallow, letters = r.choice([40, 64, 200]), r.choice([8, 16, 32]), r.choice([b"ab", b"a", b"abcd\xff\x00"])
        base = [bytes(r.choice(letters) for _ in range(r.randint(1, size + 30))) for _ in range(3)]
        text = b"".join(r.choice(base) for _ in range(r.randint(1, 12)))
        starts = np.unique(rng.integers(0, len(text), r.randint(1, 150)))
        groups = rng.integers(0, r.choice([1, 3, 20]), len(starts))
        text += bytes(size + 16)
        order, repeated = suffixes.deep_shallow(text, starts, groups, size, shallow)
        keys = [(groups[i], text[starts[i]:starts[i] + size]) for i in range(len(starts))]
        assert [keys[i] for i in order] == sorted(keys)
        assert repeated.tolist() == [keys.count(k) > 1 for k in keys]


def test_anchors_belong_to_the_window():
    r = random.Random(4)
    texts = [bytes(r.choice(b"abc ") for _ in range(n)) for n in (0, 199, 200, 201, 900, 900)]
    texts.append(texts[5][:300] + texts[4][5:])
    runs = suffixes.anchored(texts)
    seen, windows = defaultdict(set), 0
    for text, first, count, mark, key in zip(*(runs[n].tolist() for n in ("text", "first", "windows", "anchor", "key"))):
        for s in range(first, first + count):
            seen[texts[text][s:s + 200]].add((key, first + mark - s))
            windows += 1
    assert windows == sum(max(0, len(t) - 199) for t in texts)
    assert all(len(x) == 1 for x in seen.values())


@pytest.mark.parametrize("group", [10_000, 50])
def test_packing(both, group):
    from tokenizers import Tokenizer

    docs, rows = both
    library = Tokenizer.from_file(word_vocabulary())
    want, total = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for n, at in enumerate(range(0, len(ids), 2048)):
            raw = np.array(ids[at:at + 2048], "<u4").tobytes()
            want.append((doc_id, n, at, len(raw) // 4, zlib.crc32(raw), raw))
    found = packing.pack(docs, word_vocabulary(), group=group).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == sorted(want)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.01 * -(-total // 2048) + 1


def test_sum_of_squares_takes_the_least_sum():
    r = random.Random(6)
    sizes = [r.randint(1, 20) for _ in range(300)]
    bins, offsets, room = packing.sum_of_squares(np.array(sizes), 20)
    gaps: list[int] = []
    for size, place, offset in zip(sizes, bins, offsets):
        def total(at):
            left = [*gaps, 20] if at == len(gaps) else list(gaps)
            left[at] -= size
            open_ = [g for g in left if 0 < g < 20]
            return sum(open_.count(g) ** 2 for g in set(open_))
        choices = [at for at, gap in enumerate([*gaps, 20]) if gap >= size]
        assert total(place) == min(map(total, choices))
        if place == len(gaps):
            gaps.append(20)
        assert offset == 20 - gaps[place]
        gaps[place] -= size
    assert gaps == room.tolist()


@pytest.mark.parametrize("rounds", [2, 0])
def test_near_duplicates(both, rounds):
    docs, rows = both
    want = brute.near(rows)
    found = [tuple(r) for r in minhash.near_duplicates(docs, size=4, star_rounds=rounds).collect()]
    assert sorted(found) == sorted((doc_id, *want[doc_id]) for doc_id, _ in rows)


def test_near_duplicates_in_a_chain(spark):
    """Each text is a near copy of the next only; all of them are one component."""
    base = words(7, 400).split()
    rows = [(50 - i, " ".join(base[6 * i:6 * i + 220])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near(rows)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, size=4).collect()} == {d: w[1] for d, w in want.items()}
    assert minhash.drop_near_duplicates(docs, size=4).count() == len({w[1] for w in want.values()})


@pytest.mark.parametrize("rounds", [2, 0])
def test_near_duplicates_around_the_threshold(spark, rounds):
    """Sets of many sizes around one passage, with links just at, above and below 0.8."""
    base = words(70, 90).split()
    rng = random.Random(70)
    rows = [(i, " ".join([*base[:rng.randint(60, 90)], *words(100 + i, rng.randint(0, 14)).split()])) for i in range(120)]
    want = brute.near(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4, star_rounds=rounds).collect()
    assert sorted(tuple(r) for r in found) == sorted((i, *want[i]) for i, _ in rows)


def test_unlinked_documents_around_a_passage_make_no_pairs(spark):
    """A passage of three quarters of every document shares out buckets, but stands behind the prefixes."""
    base = words(71, 60)
    sets = {i: minhash.shingle_set(f"{base} {words(1_000 + i, 24)}", 4) for i in range(400)}
    sets |= {400 + i: minhash.shingle_set(f"{base} {words(1_000 + i, 24)} more", 4) for i in range(5)}
    own = spark.createDataFrame([(i, x.tobytes()) for i, x in sets.items()], "id long, shingles binary")
    pairs = minhash._prefix_pairs(own, own.select("id", F.col("id").alias("component")), 80)
    assert sorted(tuple(sorted(r)) for r in pairs.collect()) == [(i, 400 + i) for i in range(5)]


def test_near_duplicates_of_ids_with_different_texts(spark):
    a, b, c, d = (words(20 + i, 100) for i in range(4))
    rows = [(5, a), (8, a + " x"), (5, b), (9, b + " x"), (2, c), (3, c + " x"), (3, d), (None, b), (None, words(30, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted([(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size=4).collect()], key=str)
    assert found == sorted([(5, 5, True), (8, 5, False), (5, 5, True), (9, 5, False), (2, 2, True), (3, 2, False), (3, 3, True),
                            (None, 5, False), (None, None, True)], key=str)
    left = [tuple(r) for r in minhash.drop_near_duplicates(docs, size=4).collect()]
    assert sorted(left, key=str) == sorted([rows[i] for i in (0, 2, 4, 6, 8)], key=str)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (300, 200), (7, 7)] + [(500, i) for i in range(501, 560)]
    found = {r.id: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), 100: 100, 200: 100, 300: 100, **dict.fromkeys(range(500, 560), 500)}


def test_toxicity_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id"), "doc_id", "left_semi")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    count = {(r.toxic, r.predicted): r["count"] for r in found}
    assert count[1, 1] > 0.85 * (count[1, 1] + count.get((1, 0), 0))
    assert count.get((0, 1), 0) < 0.01 * count[0, 0]


def test_toxicity_on_odd_rows(spark, odd):
    docs, rows = odd
    labels = spark.createDataFrame([(i, i % 2, 0, None) for i in range(20)], "doc_id long, toxic int, quality int, score string")
    found = toxicity.toxicity(docs, labels).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    left = toxicity.drop_toxic(docs, labels)
    assert left.dtypes == docs.dtypes and left.count() == sum(r.predicted == 0 for r in found)
    nothing = labels.where("false")
    assert len({r.score for r in toxicity.toxicity(docs, nothing).collect()}) == 1


def test_grammar():
    lexicon = toxicity.Lexicon({"idiot$": (50, 50), "fool": (50, 49)}, 0.0)
    score = lambda text: sum(toxicity.clause_scores(text, lexicon))
    plain = score("what an idiot")
    assert score("you are an idiot") > plain > score("that is not an idiot") > 0
    assert score("someone said idiot") < plain
    assert score("the idiots") == 0 and score("foolish") > 0
    assert score("kill the process") == 0 < score("i will kill you or you kill me")
    assert score("") == 0
    for threat in ("i am killing you", "he kills you", "i shot you", "ich töte dich", "she stabbed them", "they are strangling him", "he punches her"):
        assert score(threat) == score("i will kill you") > 0
    assert score("killjoy you") == score("hanger you") == 0


def test_grammar_counts_repeated_words_where_they_weigh_most():
    lexicon = toxicity.Lexicon({"idiot$": (50, 50), "fool$": (50, 49)}, 0.0)
    scores = lambda text: toxicity.clause_scores(text, lexicon)
    assert scores("Shoot for the stars. I will shoot you.") == scores("I will shoot you.") != []
    assert scores("He said idiot. You are an idiot.") == scores("You are an idiot.")
    assert scores("You are an idiot. He said idiot. You idiot!") == scores("You are an idiot.")
    assert scores("this is not an idiot but what an idiot") == scores("what an idiot")
    assert scores("kill the idiot process. I will kill you.") == [*scores("the idiot process."), *scores("I will kill you.")]
    for text in ("Burn a disc; beat eggs. They beat you", "what an idiot fool, you idiot"):
        assert toxicity.document_features(text, lexicon)[0] == max(sum(scores(c)) for c in text.replace(";", ".").split("."))
    assert toxicity.document_features("an idiot and fool. you idiot", lexicon)[0] == scores("an idiot and fool")[0]


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    vocabulary = word_vocabulary()
    frames = [
        exact.exact_duplicates(none), exact.drop_exact_duplicates(none), bpe.decode(bpe.encode(none, vocabulary), vocabulary),
        pii.personal_data(none), pii.redact(none), quality.quality_verdicts(none), suffixes.drop_repeats(none),
        packing.pack(none, vocabulary), toxicity.toxicity(none, labels), toxicity.drop_toxic(none, labels),
        minhash.near_duplicates(none), minhash.drop_near_duplicates(none),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, words(1, 50)), (None, None), (5, words(1, 50))], "doc_id long, text string")
    vocabulary = word_vocabulary()
    labels = spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int")
    for found in (bpe.encode(docs, vocabulary), pii.personal_data(docs), quality.quality_verdicts(docs), suffixes.drop_repeats(docs),
                  minhash.near_duplicates(docs), toxicity.toxicity(docs, labels), packing.pack(docs, vocabulary)):
        assert sorted(str(r.doc_id) for r in found.collect()) == ["5", "None", "None"]


def test_queries_return_their_columns(spark):
    columns = {
        "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op2_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op3_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op4_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op5_suffix_array": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op6_packing": "doc_id piece start length ids_crc32 sequence_id offset", "op7_toxicity": "doc_id held_out score predicted",
        "op8_url_filters": "page_id host path rule verdict", "op9_minhash": "doc_id n_shingles component_id kept",
        "op10_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op11_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op12_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
        "op13_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    }
    assert set(QUERIES) == set(columns)
    for name, want in columns.items():
        assert QUERIES[name](spark, SF).columns[:len(want.split())] == want.split()


def test_native_operators_run_no_python(spark):
    for name in ("op1_exact_dedup", "op3_pii", "op4_quality_rules", "op8_url_filters"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_long_runs_of_digits(spark):
    docs = spark.createDataFrame([(1, "1 " * 40_000), (2, "1.2.3." * 10_000), (3, "a" * 50_000 + "@" + "b." * 20_000), (4, "+" + "1-" * 50_000)],
                                 "doc_id long, text string")
    assert pii.personal_data(docs).agg(F.sum("n_card") + F.sum("n_phone")).first()[0] == 0


def test_wanted_runs_are_cut_without_python(spark):
    """A row is a run: no Python worker holds the lists of runs of thousands of texts."""
    texts = spark.sql("""select 1L as one, 2L as two, cast('abcdefghij' as binary) as data, array(
        named_struct('key', 7L, 'first', 2, 'shape', 2048 + 1, 'sure', false, 'hot', true),
        named_struct('key', 8L, 'first', 5, 'shape', 1024, 'sure', true, 'hot', false)) as wanted""")
    pieces = suffixes._pieces(texts, 4)
    assert sorted((r.key, bytes(r.piece), r.first, r.hot) for r in pieces.collect()) == [(7, b"cdefg", 2, True), (8, b"fghi", 5, False)]
    assert "InPandas" not in pieces._jdf.queryExecution().executedPlan().toString()
