"""The filter audit against a plain loop over all orders, on odd rows."""

import itertools
import random
import re

from beaconry.llm import filter_audit, queries

BLANK = r"[^\x20\x09-\x0D]+"


def slow_audit(docs, labels):
    """Every order applied to every row, one after another."""
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, lang in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(BLANK, text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and i > smallest[text]}
        parts.setdefault(lang or "", []).append((i, {f for f in fails if fails[f]}))
    rows = set()
    for part, kept_rows in parts.items():
        found = []
        for order in itertools.permutations("ABCDE"):
            left = kept_rows
            for step, f in enumerate(order, 1):
                out = [i for i, fails in left if f in fails]
                gone = sum(f in fails for _, fails in kept_rows) - len(out)
                left = [(i, fails) for i, fails in left if f not in fails]
                found.append((f, "".join(order), step, len(left), len(out), gone, sum(fails == {f} for _, fails in kept_rows),
                              sum(i in good for i in out), sum(i in toxic for i in out)))
        for f, *row in found:
            rows.add((part, *row, sum(r[4] for r in found if r[0] == f)))
    return rows


def test_all_orders_of_odd_rows(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(300))
    pool = [None, "", " \t\x0b\n", "a " * 250, long, long + " #", long.upper(), "A b", "100%", "x" * 50_000, "\x85 " * 300, long + " é\x1c"]
    docs = [(i, rng.choice(pool), rng.choice(["en", "de", None, ""])) for i in range(80)]
    docs += [docs[3], docs[3], (None, long, "en"), (None, long, "en"), (None, None, None), (0, long, "fr"), (0, long, "fr"), (0, long, "de"), (90, long, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 85, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in docs], "doc_id long, text string, lang string, words string, mask long, digest int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_filters(frame, marks, queries.AUDITED, repeats="E").collect()
    assert {tuple(r) for r in got} == slow_audit(docs, labels) and len(got) == 4 * 600
    assert filter_audit.audit_filters(frame.limit(0), marks, queries.AUDITED, repeats="E").count() == 0
    bare = filter_audit.audit_filters(frame, marks.limit(0), {"D": queries.AUDITED["D"]}).collect()
    assert len(bare) == 4 and sum(r.kept + r.removed for r in bare) == len(docs) and not any(r.good_lost for r in bare)


def test_swaps_give_every_order_once():
    for n in range(1, 6):
        names = "ABCDE"[:n]
        diagram = filter_audit.Diagram(names, {k: (k + 1, 0, 1) for k in range(1 << n)})
        seen = {tuple(diagram.order)}
        for level in filter_audit.plain_changes(n):
            diagram.swap(level)
            seen.add(tuple(diagram.order))
        assert seen == set(itertools.permutations(names))
