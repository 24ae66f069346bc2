"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from beaconry.llm.support import documents_of, slices

# How the byte-level vocabulary splits a text before its merges, and which bytes stand for themselves in
# its printable alphabet (all others follow from 256 upwards, in order).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))

# Characters whose classes all Unicode versions agree on; a text with others is split by the tokenizer library.
PLAIN = r"[\x00-\x1b\x20-ɏ‐-‧]*"

NONE = np.iinfo(np.int64).max
CACHE_ENTRIES = 400_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in -> byte."""
    own = [b for r in PRINTABLE for b in r]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts the symbols that are left of byte sequences once all merges of a vocabulary were applied.

    A batch of sequences is one flat symbol array plus the number of the sequence of each symbol. In a round every
    sequence finds its own lowest-ranked neighbouring pair and merges all its places at once, from left to right where
    they overlap; sequences without a pair leave the arrays. A symbol's later merges always rank after the merge that
    makes it, so a round per rank and sequence equals merging one pair at a time.
    """

    def __init__(self, vocab: dict[str, int], merges: list):
        alphabet = byte_alphabet()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.of_byte = np.zeros(256, dtype=np.int64)
        for char, byte in alphabet.items():
            self.of_byte[byte] = vocab[char]

    def count(self, sequences: list[bytes]) -> np.ndarray:
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        left = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(sequences), dtype=np.int64), lengths)
        while len(symbols) > 1:
            pair = symbols[:-1] * self.width + symbols[1:]
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            real = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.where(real, self.rank[at], NONE)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, NONE], first)
            spans = np.diff(np.r_[first, len(symbols)])
            chosen = (rank == np.repeat(lowest, spans)[:-1]) & real
            # of places that overlap, as in a run of one symbol, every second one counts from the left
            run_start = chosen & ~np.r_[False, chosen[:-1]]
            since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run_start, np.arange(len(chosen)), 0))
            chosen &= since % 2 == 0
            where = np.flatnonzero(chosen)
            symbols[where] = self.made[at[where]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[where + 1] = False
            np.subtract.at(left, owner[where], 1)
            keep &= np.repeat(lowest != NONE, spans)
            symbols, owner = symbols[keep], owner[keep]
        return left


class TokenCounter:
    """Counts tokens of whole texts for a byte-level vocabulary file; one per task, with a bounded memory of pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        self.merger = RankMerger(spec["model"]["vocab"], spec["model"]["merges"])
        self.split, self.plain = regex.compile(SPLIT), regex.compile(PLAIN)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.alphabet = byte_alphabet()
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in lists of bounded size."""
        if not self.plain.fullmatch(text):
            said = self.library.pre_tokenizer.pre_tokenize_str(text)
            yield [bytes(self.alphabet[c] for c in piece).decode("utf-8", "surrogateescape") for piece, _ in said]
        elif len(text) < 1 << 20:
            yield self.split.findall(text)
        else:
            found = (m.group() for m in self.split.finditer(text))
            while some := list(itertools.islice(found, 1 << 18)):
                yield some

    def tokens(self, pieces: list[str]) -> np.ndarray:
        fresh = list(set(pieces) - self.known.keys())
        if fresh:
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
                fresh = list(set(pieces))
            counts = self.merger.count([p.encode("utf-8", "surrogateescape") for p in fresh])
            self.known.update(zip(fresh, counts.tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def __call__(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        for start, end in slices(texts):
            flat: list[str] = []
            owner: list[tuple[int, int]] = []

            def flush(flat=flat, owner=owner):
                counts = self.tokens(flat)
                np.add.at(total, np.repeat([i for i, _ in owner], [n for _, n in owner]), counts)
                flat.clear()
                owner.clear()

            for i in range(start, end):
                parts = [texts[i]]
                if self.special and any(s in texts[i] for s in self.specials):
                    parts = self.special.split(texts[i])
                    total[i] += len(parts) - 1
                for part in parts:
                    for some in self.pieces(part):
                        flat += some
                        owner.append((i, len(some)))
                        if len(flat) > 1 << 20:
                            flush()
            if flat:
                flush()
        return total


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text under a byte-level vocabulary file.

    Returns doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row, repeated rows and ids
    included. Null and empty texts have 0 tokens; a null id stays null; an empty table gives an empty one. Special
    strings inside a text are one token each, as the library does by default. Other columns are not read.
    The file must be at the same path on every executor.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            counts = counter(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = documents_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
