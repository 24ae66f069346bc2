"""Line dedup against a brute-force version, and against its SQL."""

import random

from beaconry.llm import line_dedup

SCHEMA = "doc_id long, text string, mark string, gone int, n_chars long"


def slow(rows, least):
    """rows: (id, text) with distinct ids -> text and number of lines removed of each."""
    windows = []
    for d, (key, text) in enumerate(rows):
        lines = [x.strip(" ") for x in (text or "").split("\n")]
        size = [len(x) + 1 for x in lines]
        found = set()
        for i in range(len(lines)):
            for step in (1, -1):
                j, total = i, size[i]
                while total < least and 0 <= j + step < len(lines):
                    j += step
                    total += size[j]
                if total >= least:
                    found.add((min(i, j), max(i, j)))
        windows += [(tuple(lines[a:b + 1]), (key is not None, key or 0, a), d, a, b) for a, b in found]
    first = {}
    for body, order, *_ in windows:
        first[body] = min(first.get(body, order), order)
    gone = [set() for _ in rows]
    for body, order, d, a, b in windows:
        if order != first[body]:
            gone[d] |= set(range(a, b + 1))
    return [("\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in g), len(g)) for (_, t), g in zip(rows, gone, strict=True)]


def corpus():
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdé ", k=rng.randrange(0, 30))) for _ in range(40)]
    out = [None, "", "\n", "\n\n\n\n" * 20, "again\n" * 30, " padded \npadded\n padded" * 3]
    for _ in range(80):
        lines = [rng.choice(pool) if rng.random() < 0.3 else str(rng.random()) for _ in range(rng.randrange(1, 8))]
        at = rng.randrange(len(pool) - 8)
        lines += pool[at:at + rng.randrange(9)] + [str(rng.random())] * rng.randrange(2)
        out.append("\n".join(lines))
    return [(i if i != 7 else None, t) for i, t in enumerate(out)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "m", 1, 5) for d, t in rows], SCHEMA)
    want = slow(rows, 40)
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in line_dedup.dedup_lines(docs, 40).collect())
    assert got == sorted((str(d), t, n) for (d, _), (t, n) in zip(rows, want, strict=True))
    assert sum(n for _, n in want) > 50
    kept = line_dedup.strip_repeats(docs, 40)
    assert kept.columns == docs.columns
    stays = {str(r.doc_id): (r.text, r.n_chars) for r in kept.collect()}
    for (d, before), (text, n) in zip(rows, want, strict=True):
        if n and not text.strip(" \n"):
            assert str(d) not in stays
        else:
            assert stays[str(d)] == ((text, len(text)) if n else (before, 5))


def test_repeated_rows(spark):
    long = "\n".join(f"line number {i} of a text" for i in range(6))
    docs = spark.createDataFrame([(1, long, "", 0, 0), (1, long, "", 0, 0), (2, long + "\nown", "", 0, 0), (None, "short", "", 0, 0)], SCHEMA)
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(docs, 60).collect())
    assert got == [("1", long), ("1", long), ("2", "own"), ("None", "short")]


def test_long_text(spark):
    many = "\n".join(str(i % 5000) for i in range(60_000))
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, many)], "doc_id long, text string"), 200).first()
    assert got.n_lines == 60_000 and got.text == slow([(1, many)], 200)[0][0]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.strip_repeats(none).count() == 0
