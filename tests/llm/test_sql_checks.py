"""Every query of the subpackage that has SQL gives its rows; odd input for scans and filters."""

import re

import pytest

from beaconry.llm import licenses, queries, urls
from compare import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), name, sf_dir) is None


PHRASES = queries.PHRASES


def test_licenses_on_odd_rows(spark):
    texts = [None, "", "CC-BY cc by", "(All rights) reserved; all Rights RESERVED", "general public licenseé", "ccby", "cc by by cc by",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
             "granted free of charge to any person obtaining a copy", "see there: the Apache License, Version 2.0", "x " * 30_000 + "cc by",
             "GNU General Public License"]
    docs = spark.createDataFrame([(i, t, "w", "a") for i, t in enumerate(texts)] + [(2, "cc by", "", ""), (2, "cc by", "", ""), (None, "cc by", "", "")],
                                 "doc_id long, text string, words string, anchors string")
    got = licenses.scan_licenses(docs, PHRASES).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        text = "cc by" if r.doc_id is None or (r.doc_id == 2 and r.n_words == 2) else texts[r.doc_id] or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(i, t.label) for t in PHRASES for i in range(len(words)) if tuple(words[i:i + len(t.words)]) == t.words]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({k for _, k in places})) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got if r.n_words != 2}
    assert by_id[7].labels == "mit" and by_id[7].score == 1.0 and by_id[8].labels == ""
    assert by_id[9].labels == "apache-2.0" and by_id[9].score == 0.75
    assert licenses.scan_licenses(docs.limit(0), PHRASES).count() == 0


def test_urls_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG"), (5, "http://a.org/x"), (6, "x://y://z/p?q"), (7, "http://b.example.org/es/1"),
            (8, "http://example.org/en/12#f"), (9, "http://notorg/"), (10, "http://bad.site/1"), (10, "http://bad.site/1"), (None, "http://bad.site/2"), (11, "http://com/de/")]
    pages = spark.createDataFrame([(i, u, "h", 0) for i, u in rows], "page_id long, url string, host string, good int")
    marks = spark.createDataFrame([(10, 0)] * 300 + [(5, 1)] * 400 + [(4, 1)] * 300 + [(5, None), (None, 0)], "page_id long, good int")
    got = urls.judge_urls(pages, marks, queries.RULES, floor=0.8).collect()
    assert len(got) == len(rows)
    said = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in got}
    assert said[(1, "", "")] == (None, said[(2, "", "")][1]) and said[(4, "a.example.org", "")][0] is None
    assert said[(5, "a.org", "/x")] == ("org/", "allow") and said[(6, "y:", "//z/p")][0] is None
    assert said[(7, "b.example.org", "/es/1")] == ("example.org/es/", "block") and said[(8, "example.org", "/en/12")] == ("example.org/en/1", "block")
    assert said[(9, "notorg", "/")][0] is None and said[(10, "bad.site", "/1")] == (None, "block") and said[(None, "bad.site", "/2")] == (None, "block")
    assert said[(11, "com", "/de/")] == ("com/de/", "block")
    none = urls.judge_urls(pages, marks.limit(0), [], floor=0.8)
    assert {r.verdict for r in none.collect()} == {"allow"} and urls.judge_urls(pages.limit(0), marks, queries.RULES).count() == 0
