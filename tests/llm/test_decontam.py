"""Decontamination against a brute-force version of its rule, and its parts."""

import random
import re

import numpy as np

from beaconry.llm import decontam, queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_query_finds_every_planted_item(spark):
    sf_dir = "/root/testdata/sf0.01"
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op9_decontamination(spark, sf_dir).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    planted = {(d, i) for d, w in texts.items() for i, x in items if f" {' '.join(x)} " in f" {' '.join(w)} "}
    assert planted and planted <= got
    known = dict(items)
    for r in rows:  # whatever is reported stands up to the plain recurrence over the whole document
        assert lcs(known[r.item_id], texts[r.doc_id]) / len(known[r.item_id]) >= 0.6
    for d, w in list(texts.items())[:200]:  # and what is not reported has no window that would
        for i, x in items:
            if (d, i) not in got:
                assert all(lcs(x, w[s:s + len(x)]) / len(x) < 0.85 for s in range(0, len(w), max(1, len(x) // 8)) if len(set(x) & set(w[s:s + len(x)])) >= 0.6 * len(set(x)))


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(15, 60)))) for i in range(12)] + [(50, None), (51, ""), (None, " ".join(word() for _ in range(30))), (52, " ".join(word() for _ in range(300)))]
    docs, leaks = [], set()
    for d in range(120):
        parts = [" ".join(word() for _ in range(rng.randrange(150)))]
        if d % 4 == 0:
            item, text = items[d % 12]
            text = text.split()
            if d % 8 == 0:  # a paraphrase: some words go, some are put in
                text = [w for k, w in enumerate(text) if k % 6 != 2]
                text.insert(len(text) // 3, word())
            parts += [" ".join(text).upper(), " ".join(word() for _ in range(rng.randrange(150)))]
            leaks.add((d, item))
        docs.append((d, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, items[-1][1]), (203, items[14][1]), (204, " ".join(items[0][1].split()[::-1])), (4, docs[4][1]), (None, items[3][1])]
    leaks |= {(202, 52), (203, None), (None, 3)}
    return docs, items, leaks


def test_paraphrases_and_odd_rows(spark, monkeypatch):
    docs, items, leaks = corpus()
    frame = spark.createDataFrame([(d, t, "m", "i") for d, t in docs], "doc_id long, text string, mark string, ids string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for size in (200_000, 50):  # in one round and in several
        monkeypatch.setattr(decontam, "ROUND_WORDS", size)
        got = decontam.find_leaks(frame, bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
        kept = decontam.drop_leaks(frame, bench)
        assert kept.columns == frame.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in {x for x, _ in leaks})
    for a, b in ((frame.limit(0), bench), (frame, bench.limit(0))):
        assert decontam.find_leaks(a, b).count() == 0 and decontam.drop_leaks(a, b).count() == a.count()


def test_axes_are_those_of_the_svd():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((400, 60)) * (0.8 ** np.arange(60))
    axes = decontam.latent_axes(np.ones(60), a.T @ a @ decontam.test_matrix(60))
    _, sizes, turned = np.linalg.svd(a, full_matrices=False)
    level = np.median(sizes[:axes.shape[1]] ** 2)
    for j in range(10):
        assert abs(abs(axes[:, j] @ turned[j]) - (level / sizes[j] ** 2) ** 0.25) < 1e-3


def test_common_length():
    rng = random.Random(1)
    for _ in range(200):
        a, b = [rng.randrange(6) for _ in range(rng.randrange(1, 70))], [rng.randrange(6) for _ in range(rng.randrange(90))]
        assert decontam.common_length(decontam.places_of(np.array(a)), len(a), b) == lcs(a, b)

def test_item_in_a_third_of_the_documents(spark):
    rng = random.Random(11)
    prose = [f"p{i}" for i in range(400)]
    rare = [f"r{i}" for i in range(300)]
    often = " ".join(rng.sample(prose[:60], 15))
    bench = [(0, often)] + [(i, " ".join(rng.sample(prose, 12) + rng.sample(rare, 12))) for i in range(1, 40)]
    docs, copied = [], set()
    for d in range(600):
        text = rng.choices(prose, k=150) + rng.choices(rare, k=50)
        rng.shuffle(text)
        if d % 3 == 0:
            at = rng.randrange(len(text))
            text[at:at] = often.split()
            copied.add(d)
        docs.append((d, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = decontam.find_leaks(frame, items).collect()
    assert {r.doc_id for r in found if r.item_id == 0 and r.share == 1.0} >= copied
    assert all(r.doc_id not in copied for r in decontam.drop_leaks(frame, items).collect())


def spread(rng, words, step):
    """The words in order, about ``step`` others put in after each."""
    out = []
    for w in words:
        out += [w, *(f"other{rng.randrange(10**6)}" for _ in range(int(step) + (rng.random() < step % 1)))]
    return out


def test_leaks_that_only_the_cosine_finds(spark, monkeypatch):
    """Items whose words stand too far apart for any stretch of the word rule: the latent search finds at least nine in ten."""
    rng = random.Random(21)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [rng.sample(vocabulary, 40) for _ in range(60)]
    docs = []
    for i in range(600):
        body = rng.choices(vocabulary, k=150)
        if i < 60:
            body = [*body[:60], *spread(rng, items[i], 2.5), *body[60:]]
        docs.append((i, " ".join(body)))
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    want = {(i, i) for i in range(60)}
    assert len(found & want) >= 54 and found <= want
    monkeypatch.setattr(decontam, "COSINE", 2.0)
    without = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert len(without) < 30


def test_search_does_not_meet_every_item():
    """Ten times the items cost few more looks: a passage is held against the items whose posted words it has."""
    rng = np.random.default_rng(4)
    words = rng.permutation(50_000)
    texts = [words[rng.integers(0, 50_000, 640)].astype(np.int32) for _ in range(40)]
    looks = {}
    for number in (600, 6_000):
        items = decontam.Items(list(range(number)), [rng.choice(50_000, 30, replace=False).astype(np.int32) for _ in range(number)], {f"w{k}": k for k in range(50_000)})
        idf = rng.random(50_000) + 1
        finder = decontam.Searcher(items, idf, rng.standard_normal((50_000, 8)).astype(np.float32))
        planted = [np.r_[t[:100], items.words[k], t[100:]] for k, t in enumerate(texts)]
        rows = decontam.Passages.of(planted, decontam.STRIDE, idf)
        passage, item = finder.candidates(rows)
        assert all(any(i == k and rows.text[p] == k for p, i in zip(passage, item)) for k in range(40))
        looks[number] = len(passage) / len(rows.text)
        assert {(t, i) for t, i, *_ in finder(planted)} >= {(k, k) for k in range(40)}
    assert looks[600] < 2 and looks[6_000] < 6
