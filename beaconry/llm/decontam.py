"""Benchmark decontamination by latent semantic retrieval, longest common subsequences and answer checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import bounded_batches, documents_of, lean, staged

WIDTH, STRIDE = 64, 48  # words of a passage; words from one searched passage to the next
RANK, SPARE = 128, 8
COSINE = 0.25
NEARLY, PART, ANSWER = 0.85, 0.6, 0.6
POSTED = 0.25  # share of the words needed that must be among an item's posted ones
ROUND_WORDS = 200_000  # benchmark words that are held at a time
BATCH_WORDS = 1 << 17
WORD = re.compile(r"\w+")


@dataclass
class Items:
    """Passages of some benchmark items over a vocabulary of their own words."""

    ids: list  # item of each passage
    words: list[np.ndarray]
    vocabulary: dict[str, int]

    @staticmethod
    def of(rows: list) -> Items:
        vocabulary: dict[str, int] = {}
        ids, words = [], []
        for item, text in rows:
            found = [vocabulary.setdefault(w, len(vocabulary)) for w in WORD.findall((text or "").lower())]
            parts = max(1, -(-len(found) // WIDTH))
            for part in np.array_split(np.array(found, dtype=np.int32), parts):
                if len(part):
                    ids.append(item)
                    words.append(part)
        return Items(ids, words, vocabulary)


def word_rows(texts: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Two kinds of rows: (doc_id, mark, ids) with the vocabulary's numbers of a text's words, -1 for all others, and
    (word, n) with the number of a task's documents that hold a word; word -1 counts the documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = vocabulary.get, len(vocabulary)
        frequency = np.zeros(size + 1, dtype=np.int64)
        kind = None
        for batch in lean(batches):
            kind = batch.schema.field(0).type
            out = []
            for text in batch.column(2).to_pylist():
                ids = np.array([number(w, -1) for w in WORD.findall(text.lower())], dtype=np.int32)
                present = np.zeros(size + 1, dtype=bool)
                present[ids] = True  # -1 is the last place
                present[-1] = len(ids) > 0
                frequency += present
                out.append(ids.tobytes())
            none = pa.nulls(len(out), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary()), none, none], names=names)
        if kind is not None:
            at = np.flatnonzero(frequency)
            word = np.where(at == size, -1, at)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(at), kind), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()),
                                              pa.array(word, pa.int64()), pa.array(frequency[at], pa.int64())], names=names)

    names = ["doc_id", "mark", "ids", "word", "n"]
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "mark", "text").mapInArrow(work, f"doc_id {kind}, mark long, ids binary, word long, n long")


def groups(blobs: list[bytes]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Word numbers of neighbouring texts, about ``BATCH_WORDS`` at a time, with the place of the first text."""
    held: list[np.ndarray] = []
    first = total = 0
    for i, blob in enumerate(blobs):
        if held and total + len(blob) // 4 > BATCH_WORDS:
            yield first, held
            held, first, total = [], i, 0
        held.append(np.frombuffer(blob, dtype=np.int32))
        total += len(held[-1])
    if held:
        yield first, held


@dataclass
class Passages:
    """TF-IDF rows of the passages of some texts, sparse, sorted by passage; the idf is squared, against function words."""

    text: np.ndarray  # text of each passage
    start: np.ndarray  # its first word there
    row: np.ndarray
    word: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(texts: list[np.ndarray], stride: int, idf: np.ndarray) -> Passages:
        sizes = np.array([len(t) for t in texts])
        counts = np.where(sizes > 0, -(-np.maximum(1, sizes - (WIDTH - stride)) // stride), 0)
        text = np.repeat(np.arange(len(texts)), counts)
        start = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
        long = np.minimum(WIDTH, sizes[text] - start)
        row = np.repeat(np.arange(len(text)), long)
        base = (np.cumsum(sizes) - sizes)[text] + start
        place = np.arange(len(row)) + np.repeat(base - np.cumsum(long) + long, long)
        word = np.concatenate(texts)[place] if texts else np.zeros(0, np.int32)
        known = word >= 0
        key, tf = np.unique(row[known] * np.int64(len(idf)) + word[known], return_counts=True)
        row, word = key // len(idf), key % len(idf)
        value = ((1 + np.log(tf)) * idf[word] ** 2).astype(np.float32)
        norm = np.sqrt(np.bincount(row, value.astype(np.float64) ** 2, len(text)))
        return Passages(text, start, row, word, (value / np.maximum(norm, 1e-9)[row]).astype(np.float32))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Rows times a matrix that has a row for each word; each step adds the next entry of every row that has one."""
        out = np.zeros((len(self.text), matrix.shape[1]), dtype=np.float32)
        if len(self.row):
            first = np.flatnonzero(np.r_[True, self.row[1:] != self.row[:-1]])
            size = np.diff(np.r_[first, len(self.row)])
            order = np.argsort(-size, kind="stable")  # the longest rows lead, so that those still open are a prefix
            first, size = first[order], size[order]
            total = np.zeros((len(first), matrix.shape[1]), dtype=np.float32)
            for step in range(int(size[0])):
                at = first[:np.searchsorted(-size, -step)] + step
                total[:len(at)] += matrix[self.word[at]] * self.value[at, None]
            out[self.row[first]] = total
        return out

    def back(self, matrix: np.ndarray, words: int) -> np.ndarray:
        """Transposed rows times a matrix that has a row for each passage."""
        out = np.zeros((words, matrix.shape[1]), dtype=np.float32)
        if len(self.row):
            order = np.argsort(self.word, kind="stable")
            word = self.word[order]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] = np.add.reduceat(matrix[self.row[order]] * self.value[order, None], first, axis=0)
        return out


def test_matrix(words: int) -> np.ndarray:
    random = np.random.default_rng(9).standard_normal((words, min(words, RANK + SPARE)))
    return np.linalg.qr(random)[0].astype(np.float32)


def sketch(numbered: DataFrame, idf: np.ndarray) -> np.ndarray:
    """A'A times the test matrix, A being the TF-IDF rows of all passages; each task sums its own, then tasks sum as a tree.

    The sum has a row for each benchmark word and ``RANK + SPARE`` columns, whatever the size of the corpus.
    """
    shape = test_matrix(len(idf)).shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega = test_matrix(len(idf))
        total = np.zeros(omega.shape)
        for batch in lean(batches):
            for _, texts in groups(batch.column(0).to_pylist()):
                rows = Passages.of(texts, WIDTH, idf)
                total += rows.back(rows.times(omega), len(idf))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part"])

    parts = numbered.select("ids").mapInArrow(work, "part binary").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.float32).astype(np.float64))
    return parts.treeAggregate(np.zeros(shape[0] * shape[1]), np.add, np.add, depth=3).reshape(shape)


def latent_axes(idf: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Words x rank: right singular vectors of A by the one-pass randomised (Nyström) form, the leading ones damped.

    The few leading axes hold the function words of each language and outweigh all others together. Those above the
    median power of the kept axes are scaled half way down to it (in the logarithm), so that an item that is copied very
    often, and so becomes an axis itself, keeps its weight.
    """
    omega = test_matrix(len(idf)).astype(np.float64)
    size = np.linalg.norm(product)
    if not size:
        return np.zeros((len(idf), 1), dtype=np.float32)
    shift = 1e-9 * size
    product = product + shift * omega
    core = omega.T @ product
    values, turn = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-12 * values.max()
    axes, sizes, _ = np.linalg.svd(product @ (turn[:, good] / np.sqrt(values[good])), full_matrices=False)
    power = sizes ** 2 - shift
    keep = np.flatnonzero(power > 1e-6 * power.max())[:RANK]
    power = power[keep]
    return (axes[:, keep] * np.minimum(1, (np.median(power) / power) ** 0.25)).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def common_length(places: dict[int, int], size: int, other: list[int]) -> int:
    """Length of the longest common subsequence; ``places`` has the bits of the places of each word among ``size``."""
    whole = (1 << size) - 1
    rest = whole
    for w in other:
        hit = rest & places.get(w, 0)
        rest = ((rest + hit) | (rest - hit)) & whole
    return size - rest.bit_count()


def places_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Searcher:
    """Finds passages of the items in texts.

    Whatever leaks an item has ``needed`` of its distinct words close by. So each item posts its rarest words, some more
    than it can do without, and a passage is held against those items of which it and its neighbours have enough posted
    words. Nothing here is as large as passages times items, or as words times either.
    """

    def __init__(self, items: Items, idf: np.ndarray, axes: np.ndarray):
        self.items, self.idf, self.axes = items, idf, axes
        self.latent = unit(Passages.of(items.words, WIDTH, idf).times(axes))
        sizes = np.array([len(w) for w in items.words])
        distinct = [np.unique(w).astype(np.int64) for w in items.words]
        self.distinct = [frozenset(w.tolist()) for w in distinct]
        self.many = np.array([len(w) for w in distinct])
        self.flat, self.first = np.concatenate(distinct), np.cumsum(self.many) - self.many
        # distinct words that a subsequence of that share must have
        self.needed = np.ceil(PART * sizes).astype(np.int64) - (sizes - self.many)
        self.places = [places_of(w) for w in items.words]
        self.answers = [w[-max(3, len(w) // 4):] for w in items.words]
        self.answer_places = [places_of(w) for w in self.answers]
        # what has the words needed has at least so many of the posted ones: all but the item's others
        self.asked = np.maximum(1, (self.needed * POSTED).astype(np.int64))
        left = np.maximum(self.many - self.needed + self.asked, 1)
        posted = [w[np.lexsort((w, -idf[w]))][:n] for w, n in zip(distinct, left.tolist(), strict=True)]  # the rarest in the corpus; ties by number
        words, item = np.concatenate(posted), np.repeat(np.arange(len(posted)), [len(w) for w in posted])
        order = np.argsort(words, kind="stable")
        self.posted = item[order]
        self.bounds = np.searchsorted(words[order], np.arange(len(idf) + 1))

    def beside(self, rows: Passages, row: np.ndarray, steps: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each step the passages so far from those of ``row`` in the same text, and which of the rows have one."""
        for step in steps:
            to = row + step
            keep = np.flatnonzero((to >= 0) & (to < len(rows.text)))
            keep = keep[rows.text[to[keep]] == rows.text[row[keep]]]
            yield to[keep], keep

    def candidates(self, rows: Passages) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item passage) of the items of which the passage and two to each side in its text have enough posted words."""
        start = self.bounds[rows.word]
        many = self.bounds[rows.word + 1] - start
        place = np.arange(int(many.sum())) + np.repeat(start - np.cumsum(many) + many, many)
        size = np.int64(len(self.places))
        keys, hits = np.unique(np.repeat(rows.row, many) * size + self.posted[place], return_counts=True)
        passage, item = keys // size, keys % size
        near = [(to * size + item[keep], hits[keep]) for to, keep in self.beside(rows, passage, (-2, -1, 0, 1, 2))]
        every, at = np.unique(np.concatenate([k for k, _ in near]), return_inverse=True)
        total = np.bincount(at, np.concatenate([n for _, n in near]), len(every))
        every = every[total >= self.asked[every % size]]
        return every // size, every % size

    def shared(self, rows: Passages, passage: np.ndarray, item: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
        """How many distinct words of each item stand in the passages at ``steps`` from its passage in the same text."""
        size, many = np.int64(len(self.idf)), self.many[item]
        keys = rows.row * size + rows.word  # sorted, as the rows are
        pair = np.repeat(np.arange(len(item)), many)
        word = self.flat[np.arange(len(pair)) + np.repeat(self.first[item] - np.cumsum(many) + many, many)]
        found = np.zeros(len(pair), dtype=bool)
        for step in steps:
            to = passage + step
            fit = (to >= 0) & (to < len(rows.text))
            fit[fit] = rows.text[to[fit]] == rows.text[passage[fit]]
            asked = np.where(fit, to, len(rows.text))[pair] * size + word
            found |= keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked
        return np.bincount(pair, found, len(item))

    def __call__(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, float, float, float, int]]:
        """(text, item passage, cosine, share of its words, share of its answer, place) of each leak; best first by text."""
        rows = Passages.of(texts, STRIDE, self.idf)
        if not len(rows.row):
            return
        latent = unit(rows.times(self.axes))
        passage, item = self.candidates(rows)
        for at in range(0, len(passage), 1 << 13):
            p, i = passage[at:at + (1 << 13)], item[at:at + (1 << 13)]
            enough = self.shared(rows, p, i, (-2, -1, 0, 1, 2)) >= self.needed[i]
            p, i = p[enough], i[enough]
            cosine = np.einsum("ij,ij->i", latent[p], self.latent[i])
            whole = self.shared(rows, p, i, (0, 1, 2)) >= self.needed[i]
            for one in zip(p.tolist(), i.tolist(), cosine.tolist(), whole.tolist(), strict=True):
                yield from self.held(texts, rows, *one)

    def held(self, texts: list[np.ndarray], rows: Passages, p: int, i: int, cosine: float, whole: bool) -> Iterator[tuple[int, int, float, float, float, int]]:
        """The leaks of one item around one passage: in all of its surroundings if it is close, and in each stretch from a word of it."""
        t, start, size = int(rows.text[p]), int(rows.start[p]), len(self.items.words[i])
        text = texts[t]
        if cosine >= COSINE:
            low = max(0, start - size)
            if leak := self.leak(i, text[low:start + WIDTH + size].tolist()):
                yield t, i, cosine, *leak, start
        if whole:
            stretches = range(start, min(start + WIDTH, len(text)), max(1, size // 2))
            leaks = [k for low in stretches if (k := self.leak(i, text[low:low + 2 * size].tolist()))]
            if leaks:
                yield t, i, cosine, *max(leaks), start

    def leak(self, i: int, region: list[int]) -> tuple[float, float] | None:
        """Shares of the item passage's words and of those of its answer, if these words leak it."""
        if len(self.distinct[i].intersection(region)) < self.needed[i]:
            return None
        share = common_length(self.places[i], len(self.items.words[i]), region) / len(self.items.words[i])
        if share < PART:
            return None
        answer = common_length(self.answer_places[i], len(self.answers[i]), region) / len(self.answers[i])
        return (share, answer) if share >= NEARLY or answer >= ANSWER else None


def search(numbered: DataFrame, items: Items, idf: np.ndarray, axes: np.ndarray, item_type: pa.DataType, item_kind: str) -> DataFrame:
    names = ["doc_id", "mark", "item_id", "cosine", "share", "answer", "place"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Searcher(items, idf, axes)
        for batch in lean(batches):
            found = [(first + t, *rest) for first, texts in groups(batch.column(2).to_pylist()) for t, *rest in find(texts)]
            row, item, *figures = zip(*found, strict=True) if found else ((),) * 6
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array([items.ids[i] for i in item], item_type),
                 *[pa.array(v, t) for v, t in zip(figures, (pa.float64(), pa.float64(), pa.float64(), pa.int64()), strict=True)]], names=names)

    kind = numbered.schema["doc_id"].dataType.simpleString()
    found = numbered.select("doc_id", "mark", "ids").mapInArrow(
        work, f"doc_id {kind}, mark long, item_id {item_kind}, cosine double, share double, answer double, place long")
    best = F.max(F.struct("share", "answer", "cosine", "place")).alias("best")
    return found.groupBy("doc_id", "mark", "item_id").agg(best).select("doc_id", "mark", "item_id", "best.*")


def leaks_in(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, mark, item_id, share, answer, cosine, place): leaks in ``texts`` (doc_id, mark, text)."""
    from pyspark.sql.pandas.types import to_arrow_type

    bounded_batches(texts.sparkSession)
    items = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    item_kind = items.schema["item_id"].dataType
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    rounds = max(1, -(-total // (6 * ROUND_WORDS)))
    out = None
    for number in range(rounds):  # of bounded size each; one round unless the benchmark is very large
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == number)
        held = Items.of([(r.item_id, r.text) for r in mine.collect()])
        if not held.words:
            continue
        rows = staged(word_rows(texts, held.vocabulary), "words")
        counted = {r.word: r.n for r in rows.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).collect()}
        frequency = np.array([counted.get(w, 0) for w in range(len(held.vocabulary))])
        idf = np.log((counted.get(-1, 0) + 1) / (frequency + 1)) + 1e-6
        numbered = rows.filter("word IS NULL").select("doc_id", "mark", "ids")
        axes = latent_axes(idf, sketch(numbered, idf))
        found = search(numbered, held, idf, axes, to_arrow_type(item_kind), item_kind.simpleString())
        out = found if out is None else out.unionByName(found)
    if out is None:
        return texts.filter("false").select("doc_id", "mark", F.lit(None).cast(item_kind).alias("item_id"), *[
            F.lit(None).cast(t).alias(c) for c, t in (("share", "double"), ("answer", "double"), ("cosine", "double"), ("place", "long"))])
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that hold passages of ``benchmark`` (item_id, text), verbatim or paraphrased.

    Texts become passages of ``WIDTH`` words. TF-IDF rows of all passages of the corpus, over the words of the benchmark,
    go through a distributed randomised SVD; passages whose latent cosine with an item's passage reaches ``COSINE`` are
    candidates. A candidate and its surroundings leak the item when their longest common subsequence has ``NEARLY`` of the
    item passage's words, or ``PART`` of them and ``ANSWER`` of those of its answer, the last quarter. An item that is
    copied often is a common text of the corpus and its words weigh little there, so each stretch of up to one and a half
    times an item's length is held against that rule without any cosine: all stretches that have enough of its words are.
    Only looser copies need the cosine.

    A benchmark of more than 6 x ``ROUND_WORDS`` characters is searched in rounds with a vocabulary and axes each; the
    cosines of an item, and so which of those looser copies are found, depend on the round it is in.

    Returns one row for each document and item found: doc_id, item_id, share, answer, cosine, place (the word where the
    passage starts). Documents without a leak have no row. Null and empty texts and items never leak; repeated rows of a
    document, and rows of one id, are reported once for each item, with the largest share; null ids are reported as
    null. Empty tables give an empty result; other columns are not read.
    """
    texts = documents_of(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    best = F.max(F.struct("share", "answer", "cosine", "place")).alias("best")
    return leaks_in(texts, benchmark).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text leaks no item; see ``find_leaks`` for what leaks.

    Null and empty texts leak nothing, repeated rows stay or go together, rows of a null id are told apart by their text.
    An empty table gives an empty one, an empty benchmark leaves all rows. Columns may have any names: a row travels as
    one value.
    """
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text).alias("row_mark"), text.alias("row_text"), F.struct(*docs.columns).alias("row"))
    texts = rows.select(F.col("row_id").alias("doc_id"), F.col("row_mark").alias("mark"), F.col("row_text").alias("text"))
    found = leaks_in(texts, benchmark).select(F.col("doc_id").alias("found_id"), F.col("mark").alias("found_mark")).distinct()
    same = F.col("row_id").eqNullSafe(F.col("found_id")) & (F.col("row_mark") == F.col("found_mark"))
    return rows.drop("row_text").join(found, same, "left_anti").select("row.*")
