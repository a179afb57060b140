"""The corpus pipeline over planted documents, every stage held against plain Python on what the stage before it kept."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from convocases.llm import toxicity  # noqa: E402
from convocases.llm.queries import word_vocabulary  # noqa: E402
from convocases.sources.scratch import new_path  # noqa: E402
from test_documents import words  # noqa: E402

SF = "/root/testdata/sf0.01"  # fewer documents are too few labels to fit
TOXIC = "You are an idiot and I will kill you. You stupid idiot, I hate you, I will hurt you and your family. "
PERSON = "Write to jane.doe@example.org or 10.0.0.1, card 4111 1111 1111 1111, phone +49 (30) 123-4567, IBAN DE89 3704 0044 0532 0130 00."


def planted():
    base, other = words(51, 220), words(52, 300)
    near = base.split()
    return [
        (900_001, TOXIC * 3), (900_002, words(53, 50) + " " + TOXIC * 4),
        (900_010, other), (900_011, other), (900_012, other.replace(" ", "\n ")), (None, other.replace(" ", "\t")),
        (900_020, base), (900_021, " ".join([*near[:219], "changed"])), (900_022, " ".join(["new", *near])),
        (900_030, words(54, 40) + " " + PERSON + " " + words(55, 40)), (900_031, PERSON),
        (None, words(56, 60)), (None, words(57, 60)), (None, words(57, 60)), (900_040, words(58, 60)), (900_040, words(59, 60)),
        (900_050, None), (900_051, ""), (900_052, " \n"), (900_060, words(60, 6_000)),
    ]


@pytest.fixture(scope="module")
def stages(spark):
    """What run() wrote after each stage, and its result."""
    folder = new_path(spark, "sf")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    own = spark.createDataFrame([(i, t, "en", "planted", None if t is None else len(t)) for i, t in planted()], given.schema)
    given.unionByName(own).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    kept, write = [], corpus_pipeline.checkpointed

    def keep(df):
        kept.append(write(df))
        return kept[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "checkpointed", keep)
        result = corpus_pipeline.run(spark, folder)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash", "pii", "packing"] and len(kept) == 5
    return folder, spark.read.parquet(f"{folder}/documents.parquet"), kept, result


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)


def test_columns_stay(stages):
    _, docs, kept, _ = stages
    assert all(df.columns == docs.columns for df in kept[:4])


def test_toxic_documents_go(spark, stages):
    folder, docs, kept, _ = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    score = model.scorer()
    assert rows_of(kept[0]) == sorted((r for r in rows_of(docs) if score(r[1] or "") < toxicity.THRESHOLD), key=repr)
    ids = {r[0] for r in rows_of(kept[0])}
    assert not ids & {900_001, 900_002} and {900_010, 900_020, 900_031, 900_050, 900_060} <= ids


def test_one_of_equal_texts_stays(stages):
    _, _, kept, _ = stages
    groups = {}
    for doc_id, text in rows_of(kept[0]):
        groups.setdefault("".join(c for c in text or "" if c not in brute.SPACE), []).append((-len(text or ""), doc_id is None, doc_id or 0, text))
    best = [min(g, key=lambda x: x[:3]) for g in groups.values()]
    found = rows_of(kept[1])
    assert len(found) == len(groups)
    assert sorted(repr((None if null else i, -n)) for n, null, i, _ in best) == sorted(repr((i, len(t or ""))) for i, t in found)


def test_one_of_near_copies_stays(stages):
    _, _, kept, _ = stages
    rows = rows_of(kept[1])
    tops = brute.near([(k, t) for k, (_, t) in enumerate(rows)], size=5)
    groups = {}
    for k, (_, top, _) in tops.items():
        groups.setdefault(top, []).append(rows[k])
    found = rows_of(kept[2])
    assert len(found) == len(groups) < len(rows)
    for members in groups.values():
        left = [r for r in found if r in members]
        assert len(left) == 1
        ids = [i for i, _ in members if i is not None]
        assert not ids or left[0][0] == min(ids)
    assert [i for i, _ in found if i in (900_020, 900_021, 900_022)] == [900_020]


def test_personal_data_is_replaced(stages):
    _, _, kept, _ = stages
    before, after = {(i, k): t for k, (i, t) in enumerate(rows_of(kept[2]))}, rows_of(kept[3])
    assert len(before) == len(after)
    texts = dict(after)
    assert texts[900_031] == "Write to [email] or [ip], card [card], phone [phone], IBAN [iban]."
    assert "[email] or [ip], card [card]" in texts[900_030] and "example.org" not in texts[900_030]
    clean = {(i, t) for (i, _), t in before.items() if not any(p.search(t or "") for _, p, _ in brute.BASE) and not any(c.isdigit() for c in t or "")}
    assert clean <= set(after) and len(clean) > 50
    for _, text in after:
        assert not any(brute.personal_data(text)[:2])


def test_sequences(stages):
    from tokenizers import Tokenizer

    _, _, kept, result = stages
    library = Tokenizer.from_file(word_vocabulary())
    want = []
    for doc_id, text in rows_of(kept[3]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc_id, k, at, tuple(ids[at:at + 2048])) for k, at in enumerate(range(0, len(ids), 2048))]
    rows = result.collect()
    found = [(r.doc_id, r.piece, r.start, tuple(np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(len(w[3]) for w in want) // 2048) * 1.01 + 1


def test_pipeline_of_nothing(spark):
    folder = new_path(spark, "sf")
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").where(F.lit(False)).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
