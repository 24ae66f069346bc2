"""The pipeline stage by stage, each against a plain version of its rule over what the stage before kept."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from beaconry.llm import quality, simhash
from test_line_dedup import slow as slow_lines
from test_near_copies import slow_stays

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "benchmark", "packing"]


def test_quality(spark, sf_dir, kept):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs, labels).collect()
    assert {r.doc_id for r in kept[1]} == {r.doc_id for r in scored if r.predicted} and 0 < len(kept[1]) < len(kept[0])
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.doc_id for r in kept[0] if known.get(r.doc_id) == 1]
    assert len({r.doc_id for r in kept[1]} & set(good)) > 0.95 * len(good)


def test_lines(kept):
    rows = sorted((r.doc_id, r.text) for r in kept[1])
    want = {d: (text, n) for (d, _), (text, n) in zip(rows, slow_lines(rows, 40), strict=True)}
    want = {d: text for d, (text, n) in want.items() if not n or text.strip(" \n")}
    assert {r.doc_id: r.text for r in kept[2]} == want
    before = {r.doc_id: r.n_chars for r in kept[1]}
    texts = {r.doc_id: r.text for r in kept[1]}
    assert all(r.n_chars == (before[r.doc_id] if r.text == texts[r.doc_id] else len(r.text)) for r in kept[2])


def test_near_copies(spark, sf_dir, kept):
    want = slow_stays([(r.doc_id, r.text) for r in kept[2]])
    assert sorted(r.doc_id for r in kept[3]) == want
    texts = {r.doc_id: r.text for r in kept[2]}
    assert all(r.text == texts[r.doc_id] for r in kept[3])
    # this table has no near copies of other shingles, so some are made by three more words at the end
    rows = [r for r in kept[2] if len(r.text.split()) > 150][:40]
    copies = [(10**6 + r.doc_id, f"{r.text} and {k} more", *r[2:]) for k, r in enumerate(rows)]
    docs = spark.createDataFrame([tuple(r) for r in rows] + copies, spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    left = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in left) == slow_stays([(r[0], r[1]) for r in docs.collect()]) and len(left) < len(rows) + 5


CLASHING = ["__mark", "__stays", "__as", "__id", "__found", "__gone", "root", "row", "row_id", "row_mark", "row_text", "kept", "gone", "found_id", "found_mark",
            "stays", "stays_mark", "id", "mark", "fp", "h", "line", "pos", "known", "x", "y", "label_id", "score", "item_id", "shingle", "node"]


def test_stages_keep_any_column(spark, sf_dir):
    """Input columns named like the helpers of the stages come out as they went in."""
    long = "\n".join(f"line {i} of a text that is long enough to be a repeated passage of some length" for i in range(8))
    rows = [(1, "first of all. " + long, None), (2, "second of all. " + long, None), (3, "a good text of its own", None), (4, None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", n, *[f"{c}{i}" for c in CLASHING]) for i, t, n in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() > 0, name
        for r in out.collect():
            assert [r[c] for c in CLASHING] == [f"{c}{r.doc_id}" for c in CLASHING] and (r.lang, r.source) == ("en", "s")
        if name == "lines":
            assert {r.doc_id: r.n_chars for r in out.collect()}[2] == len(out.where("doc_id = 2").first().text)


def test_stages_take_a_very_long_text(spark, sf_dir):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 50_000, 300_000)]
    rows = [(1, " ".join(words), "en", "s", 1), (2, " ".join(words[:-1]), "en", "s", 1), (3, "\n".join(words), "en", "s", 1), (4, "x" * 3_000_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, sf_dir).collect()) == [1, 4]
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["benchmark"](spark, docs, sf_dir).collect()) == [1, 2, 3, 4]
    prints = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert prints[1] == prints[2] == prints[3] == 1 and prints[4] == 4


def test_benchmark(spark, sf_dir, kept):
    words = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in kept[3] if any(i in words(r.text) for i in items)}
    assert {r.doc_id for r in kept[3]} - {r.doc_id for r in kept[4]} == leaking


def test_packing(kept):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in kept[5]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {r.doc_id for r in kept[4]}
    for r in kept[4]:
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes()) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)


def test_run_gives_the_last_stage(spark, sf_dir, kept):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, entry_points.queries()["pipeline"](spark, sf_dir).collect())) == sorted(map(key, kept[5]))


def test_stages_take_odd_and_empty_documents(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    for rows in ([], [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 500, None, "s", None)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        assert docs.count() <= 8 * max(len(rows), 1)
