"""Packing by power-of-two decomposition: no sequence crosses documents, none needs padding."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import documents_of, kept_in_worker, slices

# Fixed value: how tokens that close a word end in that vocabulary.
WORD_END = "</w>"

# Texts of other characters go to the library whole: there its normalizer composes marks and maps case.
PLAIN = r"[\x00-\x1b\x20-įı-ɏ‐-‧]*"
MOST_WORDS = 600_000  # kept in a Python worker


def word_pattern() -> re.Pattern:
    """How the word vocabulary splits a lower-cased text of ``PLAIN`` characters: contractions, letters, single digits, marks."""
    plain = re.compile(PLAIN)
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(0x2030)) if plain.fullmatch(c)}
    letters, numbers = ("".join(re.escape(c) for c, k in kinds.items() if k == kind) for kind in "LN")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")


def cuts(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of pieces of each size, lengths of all pieces): whole sequences of ``most``, then the powers of two of the rest, falling."""
    whole, rest = np.divmod(sizes, most)
    powers = most >> np.arange(1, most.bit_length())
    of, bit = np.nonzero(rest[:, None] & powers)
    number = whole + np.bincount(of, minlength=len(sizes))
    first = np.cumsum(number) - number
    lengths = np.full(int(number.sum()), most, dtype=np.int64)
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    lengths[first[of] + whole[of] + rank] = powers[bit]
    return number, lengths


def binary_pieces(n: int, most: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids."""
    return cuts(np.array([n]), most)[1].tolist()


class Numbers(dict):
    """Numbers strings in the order of their first use and remembers which are new."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, text: str) -> int:
        self.fresh.append(text)
        self[text] = number = len(self)
        return number

    def of(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, texts), np.int64, len(texts))


class Ragged:
    """Numbered rows of ids in one growing array."""

    def __init__(self):
        self.pool, self.bounds, self.rows = np.zeros(1 << 16, dtype=np.uint32), np.zeros(1 << 14, dtype=np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.bounds[self.rows])
        while used + len(ids) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros_like(self.pool)]
        while self.rows + len(sizes) + 1 > len(self.bounds):
            self.bounds = np.r_[self.bounds, np.zeros_like(self.bounds)]
        self.pool[used:used + len(ids)] = ids
        self.bounds[self.rows + 1:self.rows + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.rows += len(sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, one after the other, and how many each has."""
        start = self.bounds[rows]
        size = self.bounds[rows + 1] - start
        place = np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)
        return self.pool[place], size


class WordIds:
    """Token ids of whole texts under a word vocabulary.

    Texts are split into words, and the library encodes each word that it has not seen. What is known of words stays
    with the Python worker, up to ``MOST_WORDS``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.split, self.plain = word_pattern(), re.compile(PLAIN)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocab = self.library.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.words, self.word_ids = Numbers(), Ragged()

    def learn_words(self) -> None:
        """Encode the new words, spaces between them; an id that closes a word ends its share."""
        fresh, self.words.fresh = self.words.fresh, []
        for at in range(0, len(fresh), 4096):
            some = fresh[at:at + 4096]
            ids = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, dtype=np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not close every word")
            self.word_ids.add(ids, np.diff(ends, prepend=0))

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has."""
        if len(self.words) > MOST_WORDS:
            self.words, self.word_ids = Numbers(), Ragged()
        codes = self.words.of(words)
        self.learn_words()
        return self.word_ids.take(codes)

    def some(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, each closed by ``end_id``, and how many each text has."""
        words: list[str] = []
        counts, whole = [], {}
        for i, text in enumerate(texts):
            found = []
            if not self.plain.fullmatch(text) or any(s in text for s in self.specials):
                whole[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                found = self.split.findall(text.lower())
            words += found
            counts.append(len(found))
        ids, size = self.of_words(words)
        sizes = np.add.reduceat(np.r_[size, 0], np.r_[0, np.cumsum(counts)[:-1]].astype(np.int64)) if counts else np.zeros(0, np.int64)
        sizes = np.where(np.array(counts) > 0, sizes, 0)  # reduceat gives an empty run the entry it starts at
        ends = np.cumsum(sizes)
        if whole:
            at = [(i, int(ends[i] - sizes[i])) for i in whole]
            ids = np.insert(ids, np.repeat([p for _, p in at], [len(whole[i]) for i, _ in at]), np.concatenate([whole[i] for i, _ in at]))
            for i, found in whole.items():
                sizes[i] = len(found)
            ends = np.cumsum(sizes)
        return np.insert(ids, ends, np.uint32(end_id)), sizes + 1

    def __call__(self, texts: list[str], end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, ids, sizes) of neighbouring texts, a bounded amount at a time."""
        for start, end in slices(texts):
            yield start, *self.some(texts[start:end], end_id)


def pack(docs: DataFrame, vocabulary: str, end_id: int, most: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every document's ids, closed by ``end_id``, into sequences whose lengths are powers of two up to ``most``.

    Each piece is a sequence of its own, so no sequence crosses documents and none is padded; pieces of one length form
    a bucket (``length``) that trains as one batch shape. Returns doc_id, start, length, ids (binary: little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset (always 0). A sequence_id is unique within one evaluation of the
    result; it numbers rows by partition, without a shuffle. Null and empty texts give one piece with ``end_id`` alone;
    repeated rows are packed each for itself; a null id stays null; an empty table gives an empty one.
    """
    if most & (most - 1):
        raise ValueError("the sequence length must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_in_worker(f"words {vocabulary}", lambda: WordIds(vocabulary))
        for batch in batches:
            for first, ids, sizes in encode(batch.column(1).to_pylist(), end_id):
                number, lengths = cuts(sizes, most)
                row = np.repeat(np.arange(len(sizes)), number)
                ends = np.cumsum(lengths)
                start = ends - lengths - (np.cumsum(sizes) - sizes)[row]
                # the pieces lie one after the other in the ids, so their column is offsets into them
                offsets = pa.py_buffer(np.r_[0, 4 * ends].astype(np.int32))
                pieces = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(ids.astype("<u4", copy=False))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + row)), pa.array(start), pa.array(lengths), pieces, pa.array(sizes[row])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"])

    rows = documents_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = rows.mapInArrow(work, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Write packed sequences with one folder for each length."""
    sequences.write.partitionBy("length").parquet(path)
