"""SentencePiece encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

import codecs
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from beaconry.llm.support import documents_of, kept_in_worker

# Fixed values of the format: the mark that stands for a space, and what an unknown piece reads as.
SPACE = "▁"
UNKNOWN = " ⁇ "

CHUNKS = 200_000  # chunks, and pairs of pieces, that a worker remembers; as many older ones stay until these are full
SHORT = 48  # characters of a chunk worth remembering

codecs.register_error("each byte", lambda error: ("�", error.start + 1))


class Memory:
    """A dictionary of bounded size: full, it becomes the old one, whose entries are used until the next is full."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


class PieceCoder:
    """A merge-type model with byte fallback, identity normalization and a dummy prefix; one per Python worker.

    The encoding of a text is the one sequence of pieces in which each piece merges to itself and every two neighbours,
    merged anew from characters, give these two again: a merge across a border would show in the two pieces beside it.
    So pieces are taken from the left, longest first; one that does not go with its neighbour gives way to the longest
    piece that begins it; where none is left the position can end no piece at all, which a bit records, and the piece
    before it gives way. A position fails once, so the work is linear.

    A border that lies inside no piece of the vocabulary is never merged across. Texts are cut there, and the chunks
    between spaces are remembered.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        bytes_ = [i for i in ids if model.is_byte(i)]
        if len(bytes_) != 256 or model.normalize("a  b\tc ") != f"{SPACE}a{SPACE}{SPACE}b\tc{SPACE}":
            raise ValueError(f"{path}: needs byte fallback, a dummy prefix and no other normalization")
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_id = {int(model.id_to_piece(i)[1:-1], 16): i for i in bytes_}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.text = [model.id_to_piece(i) for i in ids]
        self.score = {self.text[i]: model.get_score(i) for i in ids if i not in special and i not in self.byte_of}
        self.id = {p: model.piece_to_id(p) for p in self.score}
        self.reads = [UNKNOWN if model.is_unknown(i) else "" if model.is_control(i) else p.replace(SPACE, " ") for i, p in enumerate(self.text)]
        if SPACE not in self.id:
            raise ValueError(f"{path}: has no piece for the space")

        own = [p for p in self.score if len(p) == 1 or self.merged(p) == [p]]  # others never come out of merging
        known = set(own)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None) for p in own}
        self.inside = {p[k:k + 2] for p in self.score for k in range(len(p) - 1)}
        self.matcher = ahocorasick.Automaton()
        for p in own:
            self.matcher.add_word(p, len(p))
        self.matcher.make_automaton()
        self.split = regex.compile(self.chunk_pattern())
        self.chunks, self.pairs = Memory(CHUNKS), Memory(CHUNKS)

    def chunk_pattern(self) -> str:
        """Where texts are cut into chunks: before spaces, and between letters and others, if no piece of this vocabulary has such a place inside."""
        letter = regex.compile(r"\p{L}").match
        if any(b == SPACE != a for a, b in self.inside):
            return "(?s).+"
        if any(SPACE != a and bool(letter(a)) != bool(letter(b)) for a, b in self.inside):
            return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        return rf"{SPACE}*\p{{L}}+|{SPACE}*[^{SPACE}\p{{L}}]+|{SPACE}+"

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by plain merging: the best-scored pair first, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in self.score]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Whether these two pieces come out side by side when their text is merged anew."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            found = left[-1] + right[0] not in self.inside or self.merged(left + right) == [left, right]
            self.pairs.put(key, found)
        return found

    def segmented(self, text: str) -> list[str]:
        """The pieces of a text whose characters are all known, by backtracking."""
        longest = [0] * len(text)
        for end, size in self.matcher.iter(text):  # ends ascend, so the last match of a start is its longest
            longest[end + 1 - size] = size
        failed = bytearray(len(text) // 8 + 1)
        pieces: list[str] = []
        shorter, pairs, size = self.shorter, self.pairs.new, len(text)
        at, piece = 0, text[:longest[0]]
        while at < size:
            left = pieces[-1] if pieces else None
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fit = left is None or pairs.get((left, piece))
                    if self.fit(left, piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(left)
                piece = shorter[pieces.pop()]
            else:
                pieces.append(piece)
                at = end
                piece = text[at:at + longest[at]] if at < size else None
        return pieces

    def chunk_ids(self, chunk: str) -> bytes:
        """The ids of a chunk, as 32-bit integers: cut at borders that no piece crosses, unknown characters as their bytes."""
        cuts = [0, *(k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in self.inside), len(chunk)]
        found: list[int] = []
        for start, end in itertools.pairwise(cuts):
            part = chunk[start:end]
            if len(part) > 1:
                found += [self.id[p] for p in self.segmented(part)]
            elif part in self.id:
                found.append(self.id[part])
            else:
                found += [self.byte_id[b] for b in part.encode("utf-8", "replace")]
        return np.array(found, np.int32).tobytes()

    def ids_of(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is None:
            found = self.chunk_ids(chunk)
            if len(chunk) <= SHORT:
                self.chunks.put(chunk, found)
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, without begin or end."""
        if not text:
            return np.zeros(0, np.int32)
        marked = SPACE + text.replace(" ", SPACE)
        found = (m.group() for m in self.split.finditer(marked)) if len(marked) > 1 << 20 else iter(self.split.findall(marked))
        parts = []
        while some := list(itertools.islice(found, 1 << 16)):
            ids = list(map(self.chunks.new.get, some))
            if None in ids:
                ids = [self.ids_of(c) if i is None else i for c, i in zip(some, ids, strict=True)]
            parts.append(b"".join(ids))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: one space mark at the very start goes, runs of bytes are read as UTF-8, an ill byte as U+FFFD."""
        ids = ids.tolist()
        if not any(map(self.byte_of.__contains__, ids)):
            text, begun = "".join(map(self.reads.__getitem__, ids)), False
        else:
            parts = []
            for is_byte, run in itertools.groupby(ids, self.byte_of.__contains__):
                if is_byte:
                    parts.append(bytes(map(self.byte_of.__getitem__, run)).decode("utf-8", "each byte"))
                else:
                    parts.append("".join(map(self.reads.__getitem__, run)))
            text, begun = "".join(parts), ids[0] in self.byte_of
        # the first piece that shows anything loses its mark; bytes and unknown pieces have none
        first = next((i for i in ids if self.reads[i] or i in self.byte_of), None)
        marked = not begun and first is not None and first not in self.byte_of and self.text[first].startswith(SPACE)
        return text[1:] if marked else text


def coder_of(model: str) -> PieceCoder:
    return kept_in_worker(f"pieces {model}", lambda: PieceCoder(model))


def id_lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Every whole text as ids of a merge-type model: doc_id, ids and, if ``decoded``, the text that the ids read as.

    Ids are those of the model's own library, without begin or end; special strings inside a text are ordinary text. A
    null or empty text has no ids; a null id stays null; repeated rows and ids stay; an empty table gives an empty one.
    Other columns are not read. Any length of text is encoded whole, in memory linear in it. The model file must be at
    the same path on every executor.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model)
        for batch in batches:
            ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), id_lists(ids)]
            if decoded:
                columns.append(pa.array([coder.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][:len(columns)])

    rows = documents_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, ids array<int>" + (", text string" if decoded else ""))


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text that every list of ids reads as: doc_id, text. A null list reads as the empty text; null ids are an error."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(model)
        for batch in batches:
            texts = [coder.decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{ids_col}` AS array<int>) AS ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, text string")
