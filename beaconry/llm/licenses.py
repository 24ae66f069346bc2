"""License scans over a positional index of rare words, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import ascii_lower, documents_of

# Everything below 0x80 that is neither a digit nor a lower-case letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

POSTED = 3  # rare words of each key phrase whose postings are intersected
SLACK = 3  # words that may stand between two words of a template beside its key phrase


@dataclass(frozen=True)
class Template:
    """Words of a license text in a row; ``key`` is the range of those that must stand there without a change."""

    label: str
    words: tuple[str, ...]
    key: tuple[int, int]

    @staticmethod
    def of(label: str, text: str, key: str) -> Template:
        words, must = tuple(text.split()), key.split()
        at = next(i for i in range(len(words)) if list(words[i:i + len(must)]) == must)
        return Template(label, words, (at, at + len(must)))


def phrase(label: str, text: str) -> Template:
    """A template that is all key phrase."""
    return Template.of(label, text, text)


# Opening or granting sentences of common licenses, as words.
TEMPLATES = [
    Template.of("apache-2.0", "licensed under the apache license version 2 0", "the apache license version 2 0"),
    Template.of("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template.of("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "granted free of charge to any person obtaining a copy"),
    Template.of("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "distribute this software for any purpose with or without fee"),
    Template.of("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "the mozilla public license"),
    Template.of("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "the gnu general public license"),
    Template.of("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Template.of("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work", "waived all copyright and related"),
    Template.of("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template.of("public-domain", "this work has been released into the public domain by its author", "released into the public domain"),
    Template.of("mit", "released under the mit license", "the mit license"),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def document_frequency(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """In how many of all documents each of the few words of the templates stands: at most a row for each such word."""
    found = docs.select(F.explode(F.array_distinct(F.filter(
        words_of(F.col("text")), lambda w: w.isin(*sorted(vocabulary))))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rarest(template: Template, frequency: dict[str, int]) -> list[int]:
    """Positions of the key phrase's words with the highest inverse document frequency, rarest first; of ties the first."""
    return sorted(range(*template.key), key=lambda j: (frequency.get(template.words[j], 0), j))[:POSTED]


def starts(words: Column, postings: dict[str, Column], template: Template, at: list[int]) -> Column:
    """Where the template begins: the postings of its rare words, each shifted by that word's position, intersected; the
    rest of the key phrase must stand there.

    A template that is cut off by the text's beginning begins below 0.
    """
    def shifted_by(j: int) -> Column:
        return F.transform(postings[template.words[j]], lambda i: i - j)

    shifted = [shifted_by(j) for j in at]
    agreed = shifted[0]
    for more in shifted[1:]:
        agreed = F.array_intersect(agreed, more)

    def holds(s: Column) -> Column:
        keep = F.lit(True)
        for j in range(*template.key):
            if j not in at:
                keep &= F.get(words, s + j) == template.words[j]
        return F.coalesce(keep, F.lit(False))

    return F.filter(agreed, holds)


def in_order(found: Column, expected: tuple[str, ...]) -> Column:
    """How many expected words stand in ``found`` in their order, each at most ``SLACK`` words after where it is awaited."""
    if not expected:
        return F.lit(0)

    def step(state: Column, word: Column) -> Column:
        ahead = F.array_position(F.slice(found, state["at"] + 1, SLACK + 1), word).cast("int")
        return F.when(ahead > 0, F.struct((state["at"] + ahead).alias("at"), (state["hits"] + 1).alias("hits"))).otherwise(state)

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("hits"))
    return F.aggregate(F.array(*[F.lit(w) for w in expected]), begin, step, lambda state: state["hits"])


def likeness(words: Column, places: Column, template: Template) -> Column:
    """The largest share of the template's words that stand at a place; 0 without a place.

    Beside the key phrase the words of each side count at their relative positions, or in their order outward from the
    key phrase with up to ``SLACK`` other words before each, whichever gives more.
    """
    first, end = template.key
    sides = [range(first), range(end, len(template.words))]

    def share(s: Column) -> Column:
        total = F.lit(end - first)
        for side in sides:
            rigid = F.lit(0)
            for j in side:
                rigid = rigid + F.coalesce((F.get(words, s + j) == template.words[j]).cast("int"), F.lit(0))
            long = len(side) + SLACK
            if side.start == 0:
                low = F.greatest(s + first - long, F.lit(0))
                found, expected = F.reverse(F.slice(words, low + 1, s + first - low)), template.words[:first][::-1]
            else:
                found, expected = F.slice(words, s + end + 1, F.lit(long)), template.words[end:]
            total = total + F.greatest(rigid, in_order(found, expected))
        return total / F.lit(float(len(template.words)))

    return F.coalesce(F.array_max(F.transform(places, share)), F.lit(0.0))


def scan_licenses(docs: DataFrame, phrases: list[Template], templates: list[Template] | None = None, least: float = 0.7,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find license phrases and license texts in every whole text.

    One pass counts in how many documents the templates' words stand; the rarest words of each key phrase, up to ``POSTED``,
    are its entries in the positional index. A second pass notes where such words stand, shifts their places by the word's
    position in its template, intersects them, keeps those with the whole key phrase and measures how much of the template is there, words missing or put in
    beside the key phrase allowed. A template counts from the share ``least`` on; one that begins before the text is placed
    at its start. Since the rare words are of the key phrase, the choice of words changes the cost and never the result. Neither pass shuffles texts.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and places (array of label and
    start, phrases first) for every row, repeated rows and ids included. Null and empty texts have no words, no places
    and score 0; a null id stays null; an empty table gives an empty one; other columns are not read. The score is 1
    with a phrase, else the largest share of a template that counts, else 0. Places of one phrase may overlap.
    """
    templates = TEMPLATES if templates is None else templates
    every = [*phrases, *templates]
    rows = documents_of(docs, id_col, text_col)
    frequency = document_frequency(rows, {w for t in every for w in t.words[slice(*t.key)]})
    at = [rarest(t, frequency) for t in every]
    rare = sorted({t.words[j] for t, chosen in zip(every, at, strict=True) for j in chosen})
    words = F.col("words")
    rows = rows.select("doc_id", words_of(F.col("text")).alias("words"))
    # the positional index of a text: where its rare words stand
    posted = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*rare), F.struct(i.alias("at"), w.alias("word")))), lambda p: p.isNotNull())
    rows = rows.withColumn("posted", posted)

    def places_of(word: str) -> Column:
        return F.transform(F.filter("posted", lambda p: p["word"] == word), lambda p: p["at"])

    rows = rows.select("doc_id", "words", *[places_of(w).alias(f"in_{k}") for k, w in enumerate(rare)])
    postings = {w: F.col(f"in_{k}") for k, w in enumerate(rare)}
    rows = rows.select("doc_id", "words", *[starts(words, postings, t, chosen).alias(f"at_{k}") for k, (t, chosen) in enumerate(zip(every, at, strict=True))])
    base = F.concat(*[F.col(f"at_{k}") for k in range(len(phrases))])
    shares = {k: likeness(words, F.col(f"at_{k}"), every[k]) for k in range(len(phrases), len(every))}
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), base.alias("base"),
                       *[F.col(f"at_{k}") for k in range(len(every))], *[v.alias(f"share_{k}") for k, v in shares.items()])
    base_labels = F.filter(F.array(*[F.when(F.size(f"at_{k}") > 0, F.lit(t.label)) for k, t in enumerate(phrases)]), lambda x: x.isNotNull())
    own_labels = F.filter(F.array(*[F.when(F.col(f"share_{k}") >= least, F.lit(every[k].label)) for k in shares], F.lit(None).cast("string")), lambda x: x.isNotNull())
    best = F.greatest(*[F.when(F.col(f"share_{k}") >= least, F.col(f"share_{k}")).otherwise(0.0) for k in shares], F.lit(0.0), F.lit(0.0))
    places = F.concat(*[F.transform(F.col(f"at_{k}"), lambda s, label=t.label: F.struct(F.lit(label).alias("label"), F.greatest(s.cast("long"), F.lit(0)).alias("start"))) for k, t in enumerate(every)])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(F.concat(base_labels, own_labels)).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"), places.alias("places"))
