"""The quality classifier: held-out accuracy, lookup tables against the trees' sums, odd rows."""

import zlib

import numpy as np

from beaconry.llm import quality, queries


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op3_quality(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    score, y = np.array(held).T
    assert auc(score, y) > 0.95 and ((score >= 0.3) == y).mean() > 0.95


def test_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and auc(model.score(x), y) > 0.95


def test_scores_are_table_sums():
    rng = np.random.default_rng(2)
    x = rng.random((500, len(quality.FEATURES)))
    model = quality.fit(x, (x[:, 3] > 0.4).astype(float))
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        bins = [int((e <= v).sum()) for e, v in zip(model.edges, row, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        total += sum(g[model.coarse[i][bins[i]], model.coarse[j][bins[j]]] for (i, j), g in zip(model.pairs, model.grids, strict=True))
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9


def test_odd_rows(spark):
    texts = [None, "", "   \n ", "word", "|", "é" * 10, "a b c\n\nd", "x " * 200_000, "ünï 12 $$$ !!"]
    docs = spark.createDataFrame([(i, t, None, 0.0) for i, t in enumerate(texts)] + [(3, "word", "", 1.0), (None, "word", "", 1.0)], "doc_id long, text string, x string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, None), (6, 1, 1), (8, None, 0), (99, 1, 0), (None, 1, 0), (7, 5, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = quality.score_quality(docs, known).collect()
        assert len(got) == len(texts) + 2 and all(0 <= r.score <= 1 for r in got)
        assert quality.keep_good(docs, known, threshold=0.0).count() == len(got)
    assert {r.score for r in got} == {0.5} and quality.keep_good(docs, labels, 1.1).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score_quality(docs.limit(0), labels).count() == 0 and quality.keep_good(docs.limit(0), labels).count() == 0
