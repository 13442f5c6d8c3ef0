"""The pipeline's stages: each one's decisions take effect, and clean documents stay."""

from __future__ import annotations

import pytest

import corpus_pipeline
from daybook.llm import lines, minhash, secrets, toxicity
from daybook.session import settle

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return corpus_pipeline.ship(spark).read.parquet(f"{SMALL}/documents.parquet")


def test_stages_do_what_their_operators_say(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    scored = toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 0")
    ids = {r.doc_id for r in clean.collect()}
    assert ids == {r.doc_id for r in scored.collect()}

    lean = corpus_pipeline.drop_repeated_lines(spark, clean, SMALL)
    want = {r.doc_id: r.text for r in lines.remove_lines(clean).collect()}
    got = {r.doc_id: r.text for r in lean.collect()}
    assert all(want[i] == t for i, t in got.items())
    assert all(not (t or "").strip() for i, t in want.items() if i not in got)

    single = corpus_pipeline.drop_near_duplicates(spark, lean, SMALL)
    assert {r.doc_id for r in single.collect()} == {
        r.doc_id for r in minhash.near_duplicates(lean).where("kept").collect()
    }

    safe = corpus_pipeline.redact_secrets(spark, single, SMALL)
    assert safe.count() == single.count()
    assert secrets.scan(safe).where("size(spans) > 0").count() == 0
    for frame in (clean, lean, single, safe):
        assert frame.columns == docs.columns


def test_whole_run_packs_every_document_that_is_left(spark):
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    ]
    assert packed.where("piece = 0").count() > 100


def test_stages_on_awkward_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns named like the operators' own."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, n_lines long, n_removed string, "
        "before string, kept boolean, score double, uid long, removed int"
    )
    run = "\n".join(f"line {i} of a run that many documents share" for i in range(4))
    key = "AKIA" + "ABCDEFGH" * 2
    long = " ".join(f"w{i % 977} x{i}" for i in range(20_000))

    def row(doc_id, text, *rest):
        return (doc_id, text, *(rest or ("en", "a", len(text or ""), 7, "mine", "b", True, 0.5, 9, 1)))

    none = (None,) * 10
    rows = [
        row(10, run + "\nfirst of all, a text of its own"), row(11, run + "\nsecond, and something else is told"),
        row(12, run), row(13, None), row(14, ""), row(15, " \n\t"), row(16, f"the key is {key} here"),
        row(17, long), row(18, long), row(19, "one and the same"), row(19, "one and the same"),
        row(None, "a row without any id", *none), row(None, None, *none),
    ]
    docs = corpus_pipeline.ship(spark).createDataFrame(rows, schema)
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(settle(stage(spark, frames[-1], SMALL), "stage"))
        assert frames[-1].columns == docs.columns
    clean, lean, single, safe = ([tuple(r) for r in f.collect()] for f in frames[1:])
    assert sorted(clean, key=repr) == sorted((tuple(r) for r in docs.collect()), key=repr)
    texts = {r[0]: r[1] for r in lean if r[0] is not None}
    assert texts[10].startswith("line 0") and texts[11] == "second, and something else is told"
    assert 12 not in texts and 18 not in texts and texts[17] == long
    assert texts[13] is None and texts[14] == "" and texts[15] == " \n\t"
    assert all(r[5:9] == (7, "mine", "b", True) for r in lean if r[0] is not None)
    assert [r[4] for r in lean if r[0] == 11] == [len(texts[11])]
    assert sorted(r[0] for r in single if r[0] is not None) == [10, 11, 13, 14, 15, 16, 17, 19]
    assert sum(r[0] is None for r in single) == 2
    assert [r[1] for r in safe if r[0] == 16] == ["the key is [access] here"]
    packed = corpus_pipeline.pack_sequences(spark, frames[-1], SMALL)
    assert packed.where("piece = 0").count() == len(safe)

    nothing = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SMALL).count() == 0
