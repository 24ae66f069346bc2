"""SimHash groups against a brute-force version."""

import random
import re

import pytest
import xxhash

from beaconry.llm import components, simhash


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows):
    """rows: (id, fingerprint) -> id of the component of each row."""
    prints = sorted({f for _, f in rows})
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [least.get(find(f)) for _, f in rows]


def texts():
    rng = random.Random(3)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    out = [None, "", " \t\n", "one", "ONE", "one two", "a b c", "x\x0by z\x1cq", "nbsp word a b", "Ä ä A a"]
    base = [rng.choices(words, k=120) for _ in range(6)]
    for _ in range(80):
        copy = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(" ".join(copy))
    return out


def test_against_brute_force(spark):
    rows = [(100 - i, t, "x", i) for i, t in enumerate(texts())] + [(7, "one two", None, None), (7, "one two", None, None), (None, "alone here now", "", 0), (None, "one", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    prints = [(d, slow_print(t)) for d, t, *_ in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(prints, slow_groups(prints), strict=True))
    assert got == want


def test_query(spark, sf_dir):
    from beaconry.llm import queries
    rows = [(r.doc_id, slow_print(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((d, f"{f:016x}", c) for (d, f), c in zip(rows, slow_groups(rows), strict=True))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, sf_dir).collect()) == want


def test_all_close_pairs(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    prints = {centre, 0, (1 << 64) - 1, 1 << 63, 1, 3 << 62}
    for _ in range(300):
        prints.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(r.a, r.b) for r in simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(-40, 40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(5, 5)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        if len(seen) > 1:
            assert got[node] == min(seen)


def test_empty(spark):
    docs = spark.createDataFrame([(5, "a b c d", "x")], "doc_id long, text string, fp string")
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.near_duplicates(docs).count() == 1
