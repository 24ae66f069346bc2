"""Removal of repeated byte strings against a brute-force version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from beaconry.llm import suffix_dedup


def slow(texts, least):
    """Kept bytes and removed runs of each text, by listing every string."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + least] for b in bodies for i in range(len(b) - least + 1))
    for body in bodies:
        gone = np.zeros(len(body) + 1, dtype=int)
        for i in range(len(body) - least + 1):
            if seen[body[i:i + least]] > 1:
                gone[i] += 1
                gone[i + least] -= 1
        mask = np.cumsum(gone)[:-1] > 0 if len(body) else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(int), 0]))
        yield bytes(np.frombuffer(body, np.uint8)[~mask]), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 6)))
    shared = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(8)]
    out = [None, "", "short", "x" * 500, "ab" * 300, "x" * 41, "x" * 39]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 40)))]
        for _ in range(rng.randrange(4)):
            piece = rng.choice(shared)
            cut = rng.randrange(len(piece) // 2 + 1)
            piece = piece[cut:len(piece) - rng.randrange(len(piece) // 3 + 1)]
            if rng.random() < 0.4 and piece:
                at = rng.randrange(len(piece))
                piece = piece[:at] + "!" + piece[at + 1:]
            parts += [piece, word()]
        out.append(" ".join(parts))
    near = shared[0] + shared[1]
    for _ in range(150):  # a group of near copies that is wider than a bucket
        at = rng.randrange(len(near))
        out.append(near[:at] + word() + near[at + 1:])
    return out + [out[20], out[21]]


def check(spark, texts, least, ids=None):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, mark string, body int").repartition(5)
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in suffix_dedup.remove_repeats(docs, least).collect())
    want = sorted((str(i), len((t or "").encode()), kept, spans) for i, t, (kept, spans) in zip(ids, texts, slow(texts, least), strict=True))
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1500)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    check(spark, corpus(seed), 40)


def test_one_bucket(spark):
    check(spark, corpus(5), 60)


def test_repeated_ids_and_rows(spark):
    long = " ".join(map(str, range(200)))
    check(spark, [long, long, "other " + long[:300], None, "no id " * 30, None, "unlike " + "".join(map(str, range(1000, 1100)))], 40, [1, 1, 1, None, None, 4, 5])


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 40).count() == 0


def test_query(spark, sf_dir):
    from beaconry.llm import queries
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(r.text.encode()), len(r.text.encode()) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                  for r, (kept, spans) in zip(rows, slow([r.text for r in rows], 400), strict=True))
    got = queries.op1_suffix_dedup(spark, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in got) == want
    # what follows the contract's columns: the size and the text of what is left
    whole = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert all(r.n_kept == r.n_bytes - r.n_removed and (r.n_removed or r.text == whole[r.doc_id]) for r in got)
    cut = [r for r in got if r.n_removed]
    assert cut and all(len(r.text.replace("\ufffd", "").encode()) <= r.n_kept for r in cut)
    assert any(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in cut)
