"""Near copies by five-word shingles against a comparison of all pairs."""

import random
import re

import pytest

from beaconry.llm import near_copies, simhash


def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def slow_stays(rows):
    """rows: (id, text) with distinct ids -> the ids that stay."""
    sets = [(d, slow_set(t)) for d, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s == t or len(s & t) >= 0.8 * len(s | t):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    return sorted(d for d in root if find(d) == d)


def copies(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return " ".join(out)


def test_against_all_pairs(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "A b c d E"]
    for _ in range(25):
        base = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(60, 400))]
        texts += [copies(rng, base, rng.randrange(1 + len(base) // 45)) for _ in range(4)]
    large = [f"v{rng.randrange(2000)}" for _ in range(200)]
    texts += [copies(rng, large, rng.randrange(8)) for _ in range(60)]  # one large group, not all of it alike
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, fp string, n int")
    kept = near_copies.one_of_each(docs)
    want = slow_stays(list(enumerate(texts)))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want


def test_one_passage_in_many_texts(spark):
    """Texts that share most, but too little, of their shingles never meet: what is proposed does not grow with their square."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(150)]
    def own(k):
        return [f"o{rng.random()}" for _ in range(k)]
    texts = [" ".join([*own(rng.randrange(25, 45)), *passage]) for _ in range(300)]
    texts += [" ".join([*own(5), *passage]) for _ in range(6)]  # these are near copies of each other, not of the rest
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == slow_stays(rows)
    sets = {i: near_copies.shingles(t, 5) for i, t in rows}
    grouped = spark.createDataFrame([(i, len(s), i) for i, s in sets.items()], "fp long, n long, root long")
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "fp long, shingles binary")
    met = {tuple(r) for r in near_copies.meeting(near_copies.rare_prefixes(grouped, held, 0.8), grouped.select("fp", "root"), 0.8).collect()}
    close = {(i, j) for i in sets for j in sets if i < j and len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))}
    assert close <= met and len(met - close) < 100 and len(rows) ** 2 > 90_000


def test_prefixes_lose_no_pair(spark):
    """Sets around the bound, of all sizes: each pair that reaches the similarity meets."""
    rng = random.Random(10)
    sets = {}
    for _ in range(40):
        base = [rng.randrange(1 << 60) for _ in range(rng.randrange(1, 60))]
        for _ in range(5):
            k = rng.randrange(len(base) // 3 + 1)
            sets[len(sets)] = set(base[k // 2:]) | {rng.randrange(1 << 60) for _ in range(k - k // 2)}
    grouped = spark.createDataFrame([(i, len(s), i) for i, s in sets.items()], "fp long, n long, root long")
    held = spark.createDataFrame([(i, bytearray(b"".join(x.to_bytes(8, "little") for x in s))) for i, s in sets.items()], "fp long, shingles binary")
    for least in (0.5, 0.8, 1.0):
        met = {tuple(r) for r in near_copies.meeting(near_copies.rare_prefixes(grouped, held, least), grouped.select("fp", "root"), least).collect()}
        close = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}
        assert close <= met and len(close) > 10


@pytest.mark.parametrize("crowd", [2_000, 20])
def test_a_loose_large_group(spark, monkeypatch, crowd):
    """Copies of one text of which few pairs are alike: linked over chains, as by all pairs, with and without probes."""
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    rng = random.Random(11)
    base = [f"v{rng.randrange(5000)}" for _ in range(150)]
    rows = [(i, copies(rng, base, rng.choice([2, 3, 4, 5, 9]))) for i in range(220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_stays(rows)
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == want and 5 < len(want) < 215


def test_columns_of_any_name(spark):
    names = ["__mark", "__stays", "__as", "id", "mark", "fp", "root", "row", "row_id", "row_mark", "stays", "stays_mark", "node", "n", "key", "s"]
    rows = [(1, "a b c d e f", *names), (2, "a b c d e f", *names), (3, "x " * 60_000, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    got = near_copies.one_of_each(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_the_pipeline_drops_copies_beyond_two_bits(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    other = [*base[:40], "one", *base[41:80], "two", *base[81:140], "three", *base[141:]]
    rows = [(1, " ".join(base), "en", "s", 0), (2, " ".join(other), "en", "s", 0), (3, " ".join(base[:100]), "en", "s", 0)]
    assert ((simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])) & (1 << 64) - 1).bit_count() > 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, sf_dir).collect()) == [1, 3]


def test_odd_rows(spark):
    rows = [(5, "a b c d e", "x"), (3, "A b c D e", "y"), (3, "A b c D e", "y"), (9, "other words are here now", None), (None, "a b c d e", None),
            (None, "no id at all here", None), (None, "no id at all here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = near_copies.one_of_each(docs)
    assert sorted((str(r.doc_id), r.text, r.fp) for r in got.collect()) == [("3", "A b c D e", "y"), ("9", "other words are here now", None), ("None", "no id at all here", None)]
    assert near_copies.one_of_each(docs.limit(0)).count() == 0


def test_simhash_alone_links_what_it_can(spark, monkeypatch):
    """Without any band, copies whose SimHashes differ in two bits at most are still found, verified and linked."""
    monkeypatch.setattr(near_copies, "band_keys", lambda found: [])
    words = [f"w{i * 7919 % 5003}" for i in range(600)]
    changed = [*words[:-1], "other"]
    half = [f"w{i}" if i % 7 == 0 else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(half)), (4, "alone in here"), (5, "")]
    prints = [near_copies.simhash_of(near_copies.shingles(t, 5)) for _, t in rows[:3]]
    assert bin((prints[0] ^ prints[1]) & ((1 << 64) - 1)).count("1") <= 2 and prints[0] != prints[2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.one_of_each(docs).collect()) == [1, 3, 4, 5]
