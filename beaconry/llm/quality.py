"""Quality classifier: a generalised additive model with pairwise interactions, as lookup tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import bounded_batches, lean, staged, whole_text

FIT_ROWS = 20_000

FEATURES = (
    "log_words", "word_length", "letters", "upper", "digits", "marks", "marks_in_row", "spaces", "lines_per_word",
    "distinct_words", "top_word", "same_next", "bare_marks", "end_marks", "distinct_lines", "longest_word",
)

LETTER, CAPITAL, DIGIT, SPACE, MARK = 1, 2, 3, 4, 5


def byte_classes() -> np.ndarray:
    out = np.full(256, MARK, dtype=np.uint8)
    out[0x80:] = LETTER  # all scripts beyond ASCII count as letters
    for low, high, kind in ((0x30, 0x3A, DIGIT), (0x41, 0x5B, CAPITAL), (0x61, 0x7B, LETTER), (0x09, 0x0E, SPACE), (0x20, 0x21, SPACE)):
        out[low:high] = kind
    return out


CLASSES = byte_classes()
CHUNK = 1 << 20


def features(text: str) -> np.ndarray:
    """The features of a whole text; shares are of bytes, words or lines and 0 where there are none."""
    raw = text.encode("utf-8")
    count, in_row = np.zeros(6, dtype=np.int64), 0
    for at in range(0, len(raw), CHUNK):
        kinds = CLASSES[np.frombuffer(raw[at:at + CHUNK], dtype=np.uint8)]
        count += np.bincount(kinds, minlength=6)
        in_row += int(((kinds[1:] == MARK) & (kinds[:-1] == MARK)).sum())
    n = max(len(raw), 1)
    words = text.split()
    if not words:
        return np.array([0, 0, *(count[k] / n for k in (LETTER, CAPITAL, DIGIT, MARK)), in_row / n, count[SPACE] / n, *[0.0] * 8])
    m = len(words)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return np.array([
        np.log1p(m), (n - count[SPACE]) / m, count[LETTER] / n, count[CAPITAL] / n, count[DIGIT] / n, count[MARK] / n, in_row / n, count[SPACE] / n,
        len(lines) / m, len(seen) / m, max(seen.values()) / m, sum(map(str.__eq__, words, words[1:])) / m,
        sum(c for w, c in seen.items() if not w[0].isalnum() and not w[-1].isalnum()) / m,
        sum(c for w, c in seen.items() if w[-1] in ".!?") / m, len(set(lines)) / max(len(lines), 1), min(max(map(len, seen)), 1000)])


def features_of(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def column(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lean(texts):
            yield pd.Series([features(t) for t in batch], dtype=object)

    return column(text)


@dataclass
class AdditiveModel:
    """score = sigmoid(base + a table entry for each feature's bin + one for each chosen pair of features)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin of a feature -> its bin in pair tables
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for j, table in enumerate(self.tables):
            out += table[bins[:, j]]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        return 1 / (1 + np.exp(-np.clip(self.raw(self.bins(np.asarray(x, dtype=np.float64))), -30, 30)))


def leaf(g: np.ndarray, h: np.ndarray, damp: float) -> np.ndarray:
    return g / (h + damp)


def tree(g: np.ndarray, h: np.ndarray, damp: float, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin of a shallow tree on one feature: the best cut of any piece, until there are enough leaves."""
    pieces = [(0, len(g))]
    while len(pieces) < leaves:
        best = (1e-9, None, 0)
        for p in pieces:
            cg, ch = np.cumsum(g[p[0]:p[1]])[:-1], np.cumsum(h[p[0]:p[1]])[:-1]
            if len(cg):
                tg, th = g[p[0]:p[1]].sum(), h[p[0]:p[1]].sum()
                gain = cg ** 2 / (ch + damp) + (tg - cg) ** 2 / (th - ch + damp) - tg ** 2 / (th + damp)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], p, p[0] + k + 1)
        if best[1] is None:
            break
        pieces.remove(best[1])
        pieces += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.empty(len(g))
    for low, high in pieces:
        out[low:high] = leaf(g[low:high].sum(), h[low:high].sum(), damp)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, damp: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts a pair's grid once in each direction."""
    corner = lambda m: np.cumsum(np.cumsum(m, axis=0), axis=1)
    cg, ch = corner(g), corner(h)
    best, where = -1.0, (1, 1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    right_g, right_h = cg[:-1, -1:] - a, ch[:-1, -1:] - b
    low_g, low_h = cg[-1:, :-1] - a, ch[-1:, :-1] - b
    rest_g, rest_h = tg - a - right_g - low_g, th - b - right_h - low_h
    gain = a ** 2 / (b + damp) + right_g ** 2 / (right_h + damp) + low_g ** 2 / (low_h + damp) + rest_g ** 2 / (rest_h + damp) - tg ** 2 / (th + damp)
    k = np.unravel_index(int(gain.argmax()), gain.shape)
    best, where = float(gain[k]), (k[0] + 1, k[1] + 1)
    out = np.empty(g.shape)
    for r in (slice(0, where[0]), slice(where[0], None)):
        for c in (slice(0, where[1]), slice(where[1], None)):
            out[r, c] = leaf(g[r, c].sum(), h[r, c].sum(), damp)
    return best, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 120, pair_rounds: int = 60, pairs: int = 6,
        rate: float = 0.15, damp: float = 5.0) -> AdditiveModel:
    """Cyclic boosting on the log loss: in each round every feature gets one shallow tree; then so do the best pairs.

    Without rows the score is 1/2; rows of one class give the smoothed rate of that class.
    """
    good = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(base=float(np.log(good / (1 - good))))
    if len(y) < 2 or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(e) + 1) * min(coarse, len(e) + 1) // (len(e) + 1) for e in model.edges]
    b = model.bins(x)
    raw = model.raw(b)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = 1 / (1 + np.exp(-raw))
            g, h = np.bincount(b[:, j], y - p, len(table)), np.bincount(b[:, j], p * (1 - p), len(table))
            step = rate * tree(g, h, damp)
            table += step
            raw += step[b[:, j]]

    def grid(i: int, j: int):
        p = 1 / (1 + np.exp(-raw))
        shape = (int(model.coarse[i].max()) + 1, int(model.coarse[j].max()) + 1)
        cell = model.coarse[i][b[:, i]] * shape[1] + model.coarse[j][b[:, j]]
        return cell, *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))

    wide = [j for j in range(x.shape[1]) if model.coarse[j].max() > 0]
    gains = sorted(((quadrants(*grid(i, j)[1:], damp)[0], i, j) for n, i in enumerate(wide) for j in wide[n + 1:]), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:pairs]]
    model.grids = [np.zeros((int(model.coarse[i].max()) + 1, int(model.coarse[j].max()) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.grids, strict=True):
            cell, g, h = grid(i, j)
            step = rate * quadrants(g, h, damp)[1]
            table += step
            raw += step.ravel()[cell]
    return model


def train(examples: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit a model to ``examples`` (doc_id, x, y).

    The driver holds at most ``fit_rows`` of them, those with the least hashes of their id, so that the sample does not
    depend on partitions; this is the only bounded sample here. Rows are counted first and those of far too large a hash
    left out, so that what is sorted for it does not grow with the number of partitions either.
    """
    mark, total, spare = F.xxhash64("doc_id"), examples.count(), 2.0
    while True:
        share = spare * fit_rows / max(total, 1)
        few = examples if share >= 1 else examples.filter(mark <= int(share * (1 << 64)) - (1 << 63))
        # sorted on executors, of which each sends one at most fit_rows rows, then written
        some = staged(few.select(mark.alias("mark"), "doc_id", "y", "x").orderBy("mark", "doc_id", "y").limit(fit_rows), "sample").collect()
        if len(some) == fit_rows or share >= 1:
            break
        spare *= 8  # ids that repeat may leave less below a hash than their number says
    some.sort(key=lambda r: (r.mark, r.doc_id is not None, r.doc_id, r.y))
    x = np.array([r.x for r in some], dtype=np.float64).reshape(len(some), len(FEATURES))
    return fit(x, np.array([r.y for r in some], dtype=np.float64))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 0 modulo 5; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def examples_of(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, x, y): features of ``marked`` (doc_id, x) beside the learnable labels 0 and 1 of ``labels``."""
    learnable = (labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("y"))
                 .filter(F.col("y").isin(0.0, 1.0) & ~held_out(F.col("label_id"))))
    return marked.join(learnable, F.col("doc_id") == F.col("label_id")).select("doc_id", "x", "y")


def score_of(x: Column, model: AdditiveModel) -> Column:
    @F.pandas_udf("double")
    def column(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in rows:
            yield pd.Series(model.score(np.stack(batch.to_list())) if len(batch) else [], dtype="float64")

    return column(x)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Score every whole text by a model that learns ``labels`` (doc_id, quality) from features of the texts alone.

    Returns doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on) for every row, repeated rows and ids
    included. Null and empty texts have all features 0 and are scored like any other text. Labels that are not 0 or 1
    and labels without a document teach nothing, repeated ones count repeatedly; without any label all scores are 1/2.
    A null id stays null and is not held out; an empty table gives an empty one; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    marked = staged(docs.select(F.col(id_col).alias("doc_id"), features_of(whole_text(text_col)).alias("x")), "features")
    model = train(examples_of(marked, labels), fit_rows)
    scored = marked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("x"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, with a score of at least ``threshold``.

    Null and empty texts are scored like any other, repeated rows stay or go together, a null id is no obstacle; without
    any label all scores are 1/2. An empty table gives an empty one. Columns may have any names.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("known")).distinct()
    ids = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    taught = ids.join(known, F.col("doc_id") == F.col("known"), "left_semi")
    marked = staged(taught.select("doc_id", features_of(F.col("text")).alias("x")), "features")
    model = train(examples_of(marked, labels), fit_rows)
    return docs.filter(score_of(features_of(whole_text(text_col)), model) >= threshold)
