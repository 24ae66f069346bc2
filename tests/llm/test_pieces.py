"""Encoding and decoding against the library of the model itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from beaconry.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(MODEL)


def texts():
    rng = random.Random(8)
    pool = "abcdeéüñ '.,!\n\t019ABZ%*$&|ßç▁"
    wide = pool + "ΣЖя中文ا́‍\x1d👍"
    odd = ["", " ", "▁", "  a  ", "<s>", "</s> <unk> <0x0A>", "\x00", "�", "\U0010ffff", "▁" * 40, "ab" * 3000, "\r\n\r\n"]
    runs = [c * k for c in " a\n=-" for k in (*range(1, 40), 700)]
    return odd + runs + ["".join(rng.choices(p, k=rng.randrange(1, 150))) for p in (pool, wide, "aeinrst ") for _ in range(400)]


def test_texts(coder, library):
    for text in texts():
        ids = coder.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert coder.decode(ids) == library.decode(ids.tolist()) == text.replace("▁", " ")


def test_any_ids_decode(coder, library):
    rng = random.Random(9)
    some = [0, 1, 2, 3, 200, 227, 228, 229, 230, 140, 130, 28705, 259, 264, 317]
    for _ in range(3000):
        ids = [rng.choice([*some, rng.randrange(32000)]) for _ in range(rng.randrange(7))]
        assert coder.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_positions_are_given_up(coder, library):
    """Words in which a longest match must give way, and runs that no memory holds."""
    backtracked = 0
    for word in {w for t in texts() for w in t.split()} | {"b" * 5000, "er" * 4000, "aeinrst" * 900}:
        greedy = []
        if all(c in coder.id for c in word):
            parts = coder.segmented(word)
            assert "".join(parts) == word and parts == coder.merged(word) if len(word) < 300 else "".join(parts) == word
            at = 0
            while at < len(word):
                greedy.append(next(word[at:e] for e in range(len(word), at, -1) if word[at:e] in coder.id))
                at += len(greedy[-1])
            backtracked += greedy != parts
        assert coder.encode(word).tolist() == library.encode(word)
    assert backtracked > 20


def test_memory_is_bounded():
    memory = pieces.Memory(3)
    for i in range(20):
        memory.put(i, i)
        assert len(memory.new) <= 3 and len(memory.old) <= 3 and memory.get(i) == i
    assert memory.get(1) is None


def test_odd_rows(spark, library):
    rows = [(i, t, "x", [1]) for i, t in enumerate(texts())] + [(2, "again", "", None), (2, "again", "", None), (None, None, None, None), (-1, "long word " * 40_000, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, ids array<int>")
    coded = pieces.encode_pieces(docs, MODEL, decoded=True)
    got = sorted((str(r.doc_id), r.ids, r.text) for r in coded.collect())
    want = sorted((str(i), library.encode(t or ""), (t or "").replace("▁", " ")) for i, t, _, _ in rows)
    assert got == want
    back = sorted((str(r.doc_id), r.text) for r in pieces.decode_pieces(coded, MODEL).collect())
    assert back == [(i, t) for i, _, t in want]
    assert pieces.encode_pieces(docs.limit(0), MODEL).count() == 0
    assert pieces.decode_pieces(spark.createDataFrame([(1, None)], "doc_id long, ids array<long>"), MODEL).collect() == [(1, "")]


def test_query_on_whole_table(spark, sf_dir, library):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert {tuple(r) for r in queries.op12_sentencepiece(spark, sf_dir).collect()} == want
