"""Token counts and packing against the tokenizer libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from beaconry.llm import packing, queries, tokens

ODD = ["", None, " ", "\n\n  \n", "it's they'll 'S", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|startoftext|>x", "aaaaaaaaaaaaaaaaaaa" * 50,
       "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "é ﬁ ½ ² ١٢٣", "日本語 テスト 한국어", "tab\there\x0b\x1c\x85\xa0nbsp", "ÉÀÜß ñandú l'été", "emoji 👍🏽 👩‍👩‍👧", "x" * 70_000,
       "  line ​ zero", "1234567890 " * 300, "Ǆ ŉ ǰ", "don't DON'T won''t", "\x00nul\x00"]


def texts():
    rng = random.Random(5)
    pool = "abcdeéüñ '.,!\n\t019ABZ%*$&|ßç"
    wide = pool + "ΣЖя中文ا́‍\x1d"
    return ODD + ["".join(rng.choices(pool, k=rng.randrange(200))) for _ in range(150)] + ["".join(rng.choices(wide, k=rng.randrange(120))) for _ in range(150)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i) for i, t in enumerate(texts())] + [(3, "again", None, None), (3, "again", None, None), (None, "no id", "en", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long")


def test_counts(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = tokens.count_tokens(docs, path, 10).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 10) for r in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_query_counts_whole_table(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in rows}
    assert {r.doc_id: r.n_tokens for r in queries.op5_token_counts(spark, sf_dir).collect()} == want


def whole_again(pieces, rows, library):
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        parts = sorted(by_doc[(r.doc_id, len(ids))], key=lambda p: p.start)
        starts = sorted({p.start for p in parts})
        assert starts[0] == 0 and sum({p.start: p.length for p in parts}.values()) == len(ids)
        for p in parts:
            piece = ids[p.start:p.start + p.length]
            assert p.length & (p.length - 1) == 0 and p.length <= 4096 and p.offset == 0
            yield p, piece


def test_packing_round_trip(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces, rows = packing.pack(docs, path, 2).collect(), docs.collect()
    for p, piece in whole_again(pieces, rows, Tokenizer.from_file(path)):
        assert bytes(p.ids) == piece.tobytes()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert sum(r.doc_id == 3 for r in pieces if r.start == 0) == 3


def test_packing_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    pieces = queries.op7_packing(spark, sf_dir).collect()
    for p, piece in whole_again(pieces, rows, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))):
        assert p.ids_crc32 == zlib.crc32(piece.tobytes())
    assert len({p.sequence_id for p in pieces}) == len(pieces)


def test_pieces():
    assert packing.binary_pieces(10_000, 4096) == [4096, 4096, 1024, 512, 256, 16]
    assert packing.binary_pieces(1, 4096) == [1] and packing.binary_pieces(4096, 4096) == [4096]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert tokens.count_tokens(none, public_tokenizers.path("byte_bpe_50k.json"), 1).count() == 0
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def test_buckets(spark, docs, tmp_path):
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2)
    packing.write_buckets(packed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == packed.count()
