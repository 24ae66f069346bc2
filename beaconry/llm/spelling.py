"""Spelling variants: words one edit apart, found by composing the vocabulary's acceptor with a one-edit transducer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import ascii_lower, bounded_batches, staged, whole_text

#: Words that one composition takes, and letters of each between what they share; larger groups are parted first.
MOST_WORDS = 20_000
MOST_LETTERS = 48
#: States that a task keeps for the groups to come.
MOST_STATES = 100_000

# A group of words: those of n letters, or of n + 1, that agree before letter lo and after letter hi of n.
GROUP = ["n", "lo", "hi", "before", "after"]


class Acceptors:
    """Minimal deterministic acceptors of sets of short strings; equal states are one, whichever set they stand in.

    A state is a number; ``steps`` has its letters in order, each with the state it leads to and how many strings go by
    smaller letters, so that a path spells a string and adds up to its place among its set in order.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.steps: list[tuple[tuple[str, int, int], ...]] = []
        self.accepts: list[bool] = []
        self.size: list[int] = []
        self.edited: dict[int, list[tuple[int, int]]] = {}
        self.longer: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def state(self, accepts: bool, steps: tuple[tuple[str, int, int], ...]) -> int:
        key = (accepts, steps)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.steps)
            self.steps.append(steps)
            self.accepts.append(accepts)
            self.size.append(accepts + sum(self.size[s] for _, s, _ in steps))
        return found

    def of(self, words: list[str], start: int, end: int, depth: int = 0) -> int:
        """The state that accepts what follows the first ``depth`` letters of sorted distinct words, which they share."""
        if end - start == 1:  # a chain, built from its end
            at = self.state(True, ())
            for letter in reversed(words[start][depth:]):
                at = self.state(False, ((letter, at, 0),))
            return at
        first = start
        accepts = len(words[start]) == depth
        start += accepts
        steps = []
        while start < end:
            letter, upto = words[start][depth], start + 1
            while upto < end and words[upto][depth] == letter:
                upto += 1
            steps.append((letter, self.of(words, start, upto, depth + 1), start - first))
            start = upto
        return self.state(accepts, tuple(steps))

    def common(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of the strings that both states accept. No edit is left: both must go the same way."""
        if a == b:
            return [(i, i) for i in range(self.size[a])]
        found = [(0, 0)] if self.accepts[a] and self.accepts[b] else []
        there = {letter: (to, skipped) for letter, to, skipped in self.steps[b]}
        for letter, to, skipped in self.steps[a]:
            if letter in there:
                other, passed = there[letter]
                found += [(skipped + i, passed + j) for i, j in self.common(to, other)]
        return found

    def replaced(self, a: int) -> list[tuple[int, int]]:
        """Places i < j of accepted strings that differ in exactly one letter."""
        if a not in self.edited:
            steps = self.steps[a]
            found = []
            for k, (_, to, skipped) in enumerate(steps):
                found += [(skipped + i, skipped + j) for i, j in self.replaced(to)]
                for _, other, passed in steps[k + 1:]:
                    found += [(skipped + i, passed + j) for i, j in self.common(to, other)]
            self.edited[a] = found
        return self.edited[a]

    def inserted(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of strings of ``a`` and of ``b``, where the latter has one letter more, put in where the two first differ."""
        if (a, b) not in self.longer:
            here = {letter: (to, skipped) for letter, to, skipped in self.steps[a]}
            found = []
            for letter, to, passed in self.steps[b]:
                if letter in here:  # no edit yet
                    next_, skipped = here[letter]
                    found += [(skipped + i, passed + j) for i, j in self.inserted(next_, to)]
                if self.accepts[a] and self.accepts[to]:
                    found.append((0, passed))
                rest = {c: (s, k) for c, s, k in self.steps[to]}
                for c, (next_, skipped) in here.items():
                    if c != letter and c in rest:
                        other, k = rest[c]
                        found += [(skipped + i, passed + k + j) for i, j in self.common(next_, other)]
            self.longer[(a, b)] = found
        return self.longer[(a, b)]


def near_pairs(machine: Acceptors, base: list[str], long: list[str], at_end: bool) -> Iterator[tuple[int, int, bool]]:
    """Pairs one edit apart: (i, j, False) for two of ``base``, (i, j, True) for one of ``base`` and one of ``long``.

    Both lists are sorted and distinct, one has strings of one length, the other of one letter more. Without
    ``at_end`` a letter put in behind the whole of the shorter one does not count: a neighbouring group has that pair.
    """
    a = machine.of(base, 0, len(base))
    for i, j in machine.replaced(a):
        yield i, j, False
    if long:
        b = machine.of(long, 0, len(long))
        for i, j in machine.inserted(a, b):
            if at_end or not long[j].startswith(base[i]):
                yield i, j, True


def filed(words: DataFrame) -> DataFrame:
    """Every word in its groups of either half: with words of its length, and with words one letter shorter."""
    size = F.length("word")
    as_n = words.withColumn("n", F.explode(F.array(size, size - 1))).where("n >= 1")
    half = F.floor(F.col("n") / 2).cast("int")
    ranged = as_n.withColumn("range", F.explode(F.array(
        F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("n").alias("hi")))))
    return grouped(ranged.select("word", "count", "n", "range.lo", "range.hi"))


def grouped(ranged: DataFrame) -> DataFrame:
    extra = F.length("word") - F.col("n")
    return ranged.select(
        "n", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("before"),
        F.substring("word", F.col("hi") + extra + 1, F.length("word")).alias("after"),
        F.substring("word", F.col("lo") + 1, F.col("hi") - F.col("lo") + extra).alias("middle"), "count")


def parted(big: DataFrame) -> DataFrame:
    """The words of large groups in two groups each, by which half of the range the edit is in."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    whole = big.select(F.concat("before", "middle", "after").alias("word"), "count", "n", F.explode(halves).alias("range"))
    return grouped(whole.select("word", "count", "n", "range.lo", "range.hi"))


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (group, middle, count), sorted: each word's near words and the best of them."""
    machine = Acceptors()
    group, base, long = None, ([], []), ([], [])
    out: list[tuple[str, int, int, str]] = []

    def settle() -> None:
        nonlocal machine
        if base[0] and len(base[0]) + len(long[0]) > 1:
            n, _, hi, before, after = group
            near: dict[tuple[bool, int], list] = {}
            for i, j, inserts in near_pairs(machine, base[0], long[0], hi == n):
                other = long if inserts else base
                for own, who, theirs, k in (((False, i), (inserts, j), other, j), ((inserts, j), (False, i), base, i)):
                    near.setdefault(own, []).append((-theirs[1][k], before + theirs[0][k] + after))
            for (inserts, i), found in near.items():
                most, form = min(found)
                out.append((before + (long if inserts else base)[0][i] + after, len(found), -most, form))
        if len(machine.steps) > MOST_STATES:
            machine = Acceptors()

    def rows(found: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        word, near, most, form = zip(*found, strict=True) if found else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(most, pa.int64()),
                                           pa.array(form, pa.string())], names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        for *key, middle, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != group:
                settle()
                group, base, long = key, ([], []), ([], [])
            into = base if len(middle) == key[2] - key[1] else long
            into[0].append(middle)
            into[1].append(count)
        if len(out) > 10_000:
            yield rows(out)
            out.clear()
    settle()
    yield rows(out)


def near_words(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) of every word that has a near one, for distinct words (word, count)."""
    bounded_batches(words.sparkSession)
    groups, found = filed(words), []
    while True:
        large = groups.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows")).where(
            (F.col("hi") - F.col("lo") > 1) & ((F.col("rows") > most) | ((F.col("hi") - F.col("lo") > MOST_LETTERS) & (F.col("rows") > 1)))).drop("rows")
        large = staged(large, "spelling")
        some = large.limit(1).count() > 0
        small = groups.join(large, GROUP, "left_anti") if some else groups
        small = small.where(F.col("hi") - F.col("lo") <= MOST_LETTERS)  # words that are alone with so long a middle have no near one
        ordered = small.repartition(*GROUP).sortWithinPartitions(*GROUP, "middle").select(*GROUP, "middle", "count")
        found.append(ordered.mapInArrow(compose, "word string, n_near long, form_n long, form string"))
        if not some:
            break
        groups = staged(parted(groups.join(large, GROUP, "left_semi")), "spelling")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    # a pair is found in one group, the one that has the letter in which the two words first differ
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def word_counts(docs: DataFrame, least_letters: int, least_count: int, damage: Callable[[Column, Column], Column] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, count) of the distinct words of whole texts: runs of Latin letters with A-Z in lower case, long and frequent enough.

    ``damage`` maps a document's id and a run to the word it counts as.
    """
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.split(whole_text(text_col), "[^A-Za-z\\u00C0-\\u00FF]+")).alias("run")).where("run <> ''")
    low = runs.select("doc_id", ascii_lower(F.col("run")).alias("run"))
    words = low.select((damage(F.col("doc_id"), F.col("run")) if damage else F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= least_count)


def group_variants(words: DataFrame, times: int = 2, most: int = MOST_WORDS) -> DataFrame:
    """Each word's form, the near word that it is likely a variant of, and the root at the end of its forms.

    Reads distinct words and their count (word, count). Words are near if one inserted, deleted or replaced code point makes
    one of the other. The form is the near word of largest count, the smallest of equal ones, if it is at least ``times``
    the word's own; else null. Returns word, form, root (the word itself if it has no form), n, n_near, form_n for every
    word.

    Null words and those of no letters are left out, repeated ones count together; other columns are not read; an empty
    table gives an empty one. A word of any length is compared whole: groups of many or of long words are parted by the
    half in which the edit lies until they are small, and none is skipped.
    """
    vocabulary = staged(words.where("length(word) > 0").groupBy("word").agg(F.sum("count").cast("long").alias("count")), "words")
    near = staged(near_words(vocabulary, most), "near")
    chosen = vocabulary.join(near, "word", "left").select(
        "word", F.col("count").alias("n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form_n") >= F.col("count") * times, F.col("form")).alias("form"),
        F.when(F.col("form_n") >= F.col("count") * times, F.col("form_n")).alias("form_n"))
    chosen = staged(chosen, "forms")

    # counts grow along the forms, so there are no rings; each round doubles the steps that a root is ahead
    roots = chosen.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        told = staged(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = told.select("word", "root")
        if not told.where("moved").limit(1).count():
            break
    return chosen.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
