"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from beaconry.llm import queries, spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def slow_groups(count, times=2):
    words = sorted(count)
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= times * count[w] else None
    found = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return found


def vocabulary(rng):
    words = {"", "a", "b", "ab", "aa", "aaa", "aaaa", "aaaaa", "aaaab", "baaaa", "é", "éa", "straße", "strasse"}
    for _ in range(60):
        word = "".join(rng.choices("abcé", k=rng.randrange(3, 14)))
        words.add(word)
        for _ in range(4):  # variants, and variants of these
            k = rng.randrange(len(word) + 1)
            word = rng.choice([word[:k] + rng.choice("abcdé") + word[k:], word[:k] + word[k + 1:], word[:k] + "z" + word[k + 1:]])
            words.add(word)
    long = "".join(rng.choices("abc", k=400))
    words |= {long, long[:200] + long[201:], long + "a", "c" + long, long[:399] + "z", "x" * 90, "x" * 91, "x" * 93, "x" * 45 + "y" + "x" * 45}
    words |= {"prefix" + a + b + "x" for a in "abcdefgh" for b in "abcdefgh"}
    return {w: rng.choice([1, 2, 3, 4, 8, 9, 20, 50]) for w in words}


@pytest.mark.parametrize("most", [3, 20_000])
def test_all_pairs(spark, most):
    """Also with a bound that parts every group as far as it goes."""
    count = vocabulary(random.Random(most))
    rows = [(w, n, "x", 1, 2) for w, n in count.items()] + [(None, 5, "x", 1, 2)]
    words = spark.createDataFrame(rows, "word string, count long, form string, n int, lo int").repartition(3)
    got = spelling.group_variants(words, most=most).collect()
    del count[""]
    assert {tuple(r) for r in got} == slow_groups(count) and len(got) == len(count)


def test_repeated_and_no_rows(spark):
    words = spark.createDataFrame([("hello", 1), ("hello", 2), ("hallo", 6)], "word string, count int")
    assert {tuple(r) for r in spelling.group_variants(words).collect()} == slow_groups({"hello": 3, "hallo": 6})
    assert spelling.group_variants(words.limit(0)).count() == 0


def test_pairs_once():
    """Each pair comes from one place, and from one alignment, in repeats too."""
    words = sorted({a + b + c for a in ("a", "aa", "b") for b in ("", "a", "bb") for c in ("a", "ba")})
    for size in {len(w) for w in words}:
        base, long = [w for w in words if len(w) == size], [w for w in words if len(w) == size + 1]
        found = list(spelling.near_pairs(spelling.Acceptors(), base, long, True))
        assert len(found) == len(set(found))
        said = Counter(frozenset((base[i], (long if more else base)[j])) for i, j, more in found)
        want = {frozenset((a, b)) for a in base for b in base + long if one_edit(a, b)}
        assert set(said) == want and set(said.values()) <= {1}


def test_equal_states_are_one():
    machine = spelling.Acceptors()
    start = machine.of(sorted(["tap", "taps", "top", "tops"]), 0, 4)
    assert machine.size[start] == 4 and len(machine.steps) == 5  # t, a or o, p, s and the end


def slow_words(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def test_words_of_odd_rows(spark):
    rng = random.Random(6)
    base = ["".join(rng.choices("aeilnrstüÉÑ×", k=rng.randrange(3, 9))) for _ in range(60)]
    docs = [(i, rng.choice([" ", "-", "\n", "1"]).join(rng.choices(base, k=400))) for i in range(30)]
    docs += [(40, None), (41, ""), (42, "§§ 12 \x00"), (None, "Straße STRASSE " * 5), (7, docs[7][1]), (7, docs[7][1]), (50, "ab" * 30_000 + " Äpfel " * 20_000)]
    docs += [(51, "ab" * 30_000), (52, "ab" * 30_000), (53, ("ab" * 30_000 + "c ") * 3)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, run int")
    words = spelling.word_counts(frame, 5, 3, queries.damaged)
    want = slow_words(docs)
    assert {tuple(r) for r in words.collect()} == set(want.items())
    got = {tuple(r) for r in spelling.group_variants(words).collect()}
    assert got == slow_groups(want)
    plain = spelling.word_counts(spark.createDataFrame([(1, "Hello hello HELLO Ähm ähm")], "doc_id long, text string"), 3, 1)
    assert {tuple(r) for r in plain.collect()} == {("hello", 3), ("Ähm", 1), ("ähm", 1)}
