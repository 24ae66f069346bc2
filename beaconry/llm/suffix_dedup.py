"""Removal of repeated byte strings over a sparse suffix array.

All suffixes of a corpus would be as many rows as it has bytes. Instead every string of ``least`` bytes gets one anchor
that depends on the string alone (the least hash of the k-byte strings in it, the leftmost of ties), so that equal strings
have their anchors at equal places. An anchor is chosen by a run of neighbouring strings; that run, its *block*, is
the unit of work. Suffixes that start at anchors whose k bytes stand nowhere else cannot repeat and leave at once; blocks
that are repeated whole are settled by count. What is left is the rims of repeats: their suffixes are range-partitioned by
leading bytes with sampled splitters, sorted in each bucket by multikey quicksort, compared with their neighbours, and
compared across boundaries where suffixes of equal leading bytes are too many to be held together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from beaconry.llm.support import documents_of, lean, staged

PLACE_BITS = 24  # of an anchor's key; texts are scanned in stretches below 2 ** PLACE_BITS bytes
STRETCH = 1 << 18
BUCKET_BYTES = 8 << 20  # of suffixes, wanted in a bucket and held in a task at a time
MOST_BUCKETS = 10_000  # and so most borders on the driver; buckets of larger inputs grow, what a task holds does not
SAMPLES = 20  # suffixes that are sampled for each splitter
LEAD = 16  # leading bytes by which suffixes are ordered; a hash of k bytes tells equal leads apart
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd


def byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class AnchorScan:
    """Finds the anchors of all strings of ``least`` bytes of a stretch of bytes."""

    def __init__(self, least: int, k: int):
        self.least, self.k, self.width = least, k, least - k + 1
        self.values = byte_values()
        self.up, self.down = np.ones(0, np.uint64), np.ones(0, np.uint64)
        self.grow(STRETCH + 1)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            for name, base in (("up", MULTIPLIER), ("down", np.uint64(inverse(int(MULTIPLIER))))):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(anchor, first string, last string, hash of the k bytes), all as places in ``data``.

        ``starts`` and ``ends`` bound the texts in ``data``; strings that leave their text do not count.
        """
        n, k, w = len(data), self.k, self.width
        empty = np.zeros(0, np.int64)
        if n < self.least:
            return empty, empty, empty, np.zeros(0, np.uint64)
        self.grow(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.down[:n - k + 1]
        h ^= h >> np.uint64(32)
        h *= MULTIPLIER
        place = np.uint64((1 << PLACE_BITS) - 1)
        key = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        # least key of each window of w: within blocks of w, the least from the left and from the right
        rows = -(-len(key) // w)
        padded = np.full(rows * w, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:len(key)] = key
        grid = padded.reshape(rows, w)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        strings = n - self.least + 1
        anchor = (np.minimum(right[:strings], left[w - 1:w - 1 + strings]) & place).astype(np.int64)
        whole = np.zeros(n + 1, dtype=np.int8)  # strings that lie inside one text
        long = ends - starts >= self.least
        np.add.at(whole, starts[long], 1)
        np.add.at(whole, ends[long] - self.least + 1, -1)
        inside = np.cumsum(whole[:strings]) > 0
        first = inside & np.r_[True, (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (whole[1:strings] > 0)]
        last = inside & np.r_[first[1:] | ~inside[1:], True]
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        p = anchor[a]
        return p, a, b, h[p]


def binary_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32 if pa.types.is_binary(column.type) else np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def stretches(offsets: np.ndarray, least: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Ranges of bytes to scan at a time, each with the (text, start, end) in it.

    A text that is longer than a stretch is scanned in pieces that share ``least - 1`` bytes, so each string lies in one.
    """
    held: list[tuple[int, int, int]] = []
    for i in range(len(offsets) - 1):
        start, end = int(offsets[i]), int(offsets[i + 1])
        if held and end - held[0][1] > STRETCH:
            yield held[0][1], held[-1][2], held
            held = []
        while end - start > STRETCH:
            yield start, start + STRETCH, [(i, start, start + STRETCH)]
            start += STRETCH - least + 1
        held.append((i, start, end))
    if held:
        yield held[0][1], held[-1][2], held


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def anchor_rows(texts: DataFrame, least: int, k: int) -> DataFrame:
    """(doc_id, mark, p, a, b, gram, body): anchors of ``texts`` (doc_id, mark, body bytes), places within the text.

    gram hashes the k bytes at the anchor, body the whole block, bytes a to b + least.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = AnchorScan(least, k)
        for batch in lean(batches):
            data, offsets = binary_column(batch.column(2))
            for low, high, held in stretches(offsets, least):
                starts = np.array([s for _, s, _ in held]) - low
                ends = np.array([e for _, _, e in held]) - low
                p, a, b, gram = scan(data[low:high], starts, ends)
                if not len(p):
                    continue
                which = np.searchsorted(starts, a, side="right") - 1
                row = np.array([i for i, _, _ in held])[which]
                block = data[low:high].tobytes()
                body = [xxhash.xxh3_64_intdigest(block[s:e]) for s, e in zip(a.tolist(), (b + least).tolist(), strict=True)]
                base = offsets[row] - low
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(p - base), pa.array(a - base), pa.array(b - base),
                     pa.array(signed(gram)), pa.array(signed(np.array(body, dtype=np.uint64)))],
                    names=["doc_id", "mark", "p", "a", "b", "gram", "body"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(work, f"doc_id {kind}, mark long, p long, a long, b long, gram long, body long")


def sorted_classes(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of rows by (group, words), by multikey quicksort: level by level, only rows whose prefixes still tie."""
    order = np.argsort(group, kind="stable")
    tie = np.r_[False, group[order][1:] == group[order][:-1]]
    for depth in range(words.shape[1]):
        again = tie | np.r_[tie[1:], False]
        at = np.flatnonzero(again)
        if not len(at):
            break
        bucket = np.cumsum(~tie[at])  # a run of ties is a bucket of the next level
        rows = order[at]
        key = words[rows, depth]
        inner = np.lexsort((key, bucket))
        order[at] = rows[inner]
        same = np.r_[False, (bucket[inner][1:] == bucket[inner][:-1]) & (key[inner][1:] == key[inner][:-1])]
        tie[at] = same
    return order


def common(matrix: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it in the order; -1 where another group begins."""
    out = np.full(len(order), -1, dtype=np.int64)
    for at in range(1, len(order), 65536):
        to = min(len(order), at + 65536)
        differ = matrix[order[at:to]] != matrix[order[at - 1:to - 1]]
        out[at:to] = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    out[1:][group[order][1:] != group[order][:-1]] = -1
    return out


def side_matrix(blob: np.ndarray, start: np.ndarray, step: int, size: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes read from ``start`` in direction ``step``, zero beyond ``size``."""
    j = np.arange(-(-width // 8) * 8)
    out = np.zeros((len(start), len(j)), dtype=np.uint8)
    for at in range(0, len(start), 2048):
        place = start[at:at + 2048, None] + step * j[None, :]
        inside = j[None, :] < np.minimum(size[at:at + 2048], width)[:, None]
        out[at:at + 2048] = np.where(inside, blob[np.clip(place, 0, len(blob) - 1)], 0)
    return out


class Bucket:
    """Blocks of one bucket: which of their strings stand in another block of the bucket."""

    def __init__(self, bodies: list[bytes], p: np.ndarray, a: np.ndarray, b: np.ndarray, least: int, k: int):
        self.least, self.p, self.a, self.b = least, p, a, b
        size = np.array([len(x) for x in bodies], dtype=np.int64)
        blob = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        anchor = np.cumsum(size) - size + (p - a)
        self.right = side_matrix(blob, anchor, 1, size - (p - a), least)
        self.back = side_matrix(blob, anchor - 1, -1, p - a, least - k)
        lead = np.ascontiguousarray(self.right[:, :k])
        _, self.group = np.unique(lead.view(f"V{k}").ravel(), return_inverse=True)
        self.group = self.group.ravel()

    def repeated(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each distance o of string and anchor: o, the blocks that have such a string, their classes of equal ones."""
        words = lambda m: m.view(">u8").astype(np.uint64)
        to_right = sorted_classes(words(self.right), self.group)
        to_back = sorted_classes(words(self.back), self.group)
        shared_right, shared_back = common(self.right, to_right, self.group), common(self.back, to_back, self.group)
        one, two = np.empty(len(self.p), np.int64), np.empty(len(self.p), np.int64)
        nearest, furthest = self.p - self.b, self.p - self.a
        for o in range(int(nearest.min()), int(furthest.max()) + 1):
            rows = np.flatnonzero((nearest <= o) & (o <= furthest))
            if len(rows):
                one[to_right] = np.cumsum(shared_right < self.least - o)
                two[to_back] = np.cumsum(shared_back < o)
                _, classes = np.unique(one[rows] * (len(self.p) + 1) + two[rows], return_inverse=True)
                yield o, rows, classes.ravel()


@dataclass
class Splitters:
    """Borders of the buckets of suffixes."""

    borders: np.ndarray

    @staticmethod
    def keys(lead: list[bytes], gram: np.ndarray, mark: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Sort keys: leading bytes, hash of the k bytes, and text and place to split suffixes that agree in both."""
        tail = np.stack([gram, mark, p], axis=1).astype(">i8").view("S24").ravel()
        return np.array([x.ljust(LEAD, b"\0") + t.ljust(24, b"\0") for x, t in zip(lead, tail.tolist(), strict=True)], dtype=f"S{LEAD + 24}")

    @staticmethod
    def of(sample: list, buckets: int) -> Splitters:
        """Quantiles of the sampled suffixes (lead, gram, mark, p, heavy).

        A border is moved in front of all suffixes with its leading bytes, unless these are too many to be held together.
        """
        if not sample:
            return Splitters(np.zeros(0, f"S{LEAD + 24}"))
        gram = np.array([r.gram for r in sample], dtype=np.int64)
        keys = Splitters.keys([bytes(r.lead) for r in sample], gram, np.array([r.mark for r in sample]), np.array([r.p for r in sample]))
        order = np.argsort(keys, kind="stable")
        at = order[np.unique(np.arange(1, buckets) * len(order) // buckets)]
        whole = [key if sample[i].heavy else key[:LEAD + 8] for key, i in zip(keys[at].tolist(), at.tolist(), strict=True)]
        return Splitters(np.unique(np.array(whole, dtype=f"S{LEAD + 24}")))


def deal(blocks: DataFrame, splitters: Splitters, k: int) -> DataFrame:
    """``blocks`` with the number of the bucket of each."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name, batch=batch: batch.column(batch.schema.get_field_index(name))
            lead = [x[i:i + min(LEAD, k)] for x, i in zip(column("bytes").to_pylist(), (column("p").to_numpy() - column("a").to_numpy()).tolist(), strict=True)]
            keys = Splitters.keys(lead, column("gram").to_numpy(), column("mark").to_numpy(), column("p").to_numpy())
            yield batch.append_column("bucket", pa.array(np.searchsorted(splitters.borders, keys, side="right"), pa.int64()))

    schema = StructType([*blocks.schema.fields, StructField("bucket", LongType())])
    return blocks.mapInArrow(work, schema)


def held_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``BUCKET_BYTES`` of a sorted stream of blocks; only heavy suffixes are cut between two tables."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        gram = batch.column(batch.schema.get_field_index("gram")).to_numpy()
        heavy = batch.column(batch.schema.get_field_index("heavy")).to_numpy(zero_copy_only=False)
        bytes_ = np.diff(binary_column(batch.column(batch.schema.get_field_index("bytes")))[1])
        last = held[-1].column(held[-1].schema.get_field_index("gram"))[-1].as_py() if held else None
        may_cut = heavy | np.r_[batch.num_rows > 0 and gram[0] != last, gram[1:] != gram[:-1]]
        start = 0
        for i in range(batch.num_rows):
            if size >= BUCKET_BYTES and may_cut[i]:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks()
                held, size, start = [], 0, i
            size += int(bytes_[i])
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def compare_buckets(blocks: DataFrame, least: int, k: int) -> DataFrame:
    """Repeated strings of ``blocks`` (doc_id, mark, p, a, b, n, gram, heavy, bytes, bucket), dealt and sorted.

    Rows have first and last, the places of neighbouring repeated strings of a block with n = 1; or, for heavy blocks,
    whose suffixes are not all held together, one distinct string each with its 128-bit hash, to be compared with those
    held elsewhere: open says that it awaits that, the others only answer.
    """
    fields = [("first", pa.int64()), ("last", pa.int64()), ("left_hash", pa.int64()), ("right_hash", pa.int64()), ("open", pa.bool_())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in held_together(lean(batches)):
            yield from compared(rows)

    def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        p, a, b, n = (rows.column(c).to_numpy() for c in ("p", "a", "b", "n"))
        bodies = rows.column("bytes").to_pylist()
        bucket = Bucket(bodies, p, a, b, least, k)
        rim = rows.column("heavy").to_numpy()
        single = n == 1
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        asked: list[tuple[int, int, bytes, bool]] = []
        for o, which, classes in bucket.repeated():
            count = np.bincount(classes)
            known = np.zeros(len(count), dtype=bool)  # repeated for certain: twice here, or in a block that is there twice
            known[(count > 1)] = True
            known[classes[~single[which]]] = True
            found = which[known[classes] & single[which]]
            hits.append((found, p[found] - o))
            at_rim = np.flatnonzero(rim[which])
            _, firsts = np.unique(classes[at_rim], return_index=True)
            for i in at_rim[firsts].tolist():
                row = int(which[i])
                s = int(p[row]) - o
                asked.append((row, s, xxhash.xxh3_128_digest(bodies[row][s - int(a[row]):s - int(a[row]) + least]), not known[classes[i]]))
                if len(asked) >= 1 << 16:
                    yield questions(rows, asked)
                    asked = []
        if asked:
            yield questions(rows, asked)
        row = np.concatenate([r for r, _ in hits])
        place = np.concatenate([s for _, s in hits])
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.zeros(0, np.int64)
        stops = np.r_[begins[1:] - 1, len(row) - 1] if len(row) else begins
        yield out(rows, row[begins], [place[begins], place[stops], None, None, np.zeros(len(begins), bool)])

    def questions(rows: pa.Table, asked: list) -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(h for _, _, h, _ in asked), dtype=">i8").astype(np.int64).reshape(-1, 2)
        place = np.array([s for _, s, _, _ in asked])
        return out(rows, np.array([r for r, _, _, _ in asked]), [place, place, halves[:, 0], halves[:, 1], np.array([x for *_, x in asked])])

    def out(rows: pa.Table, row: np.ndarray, columns: list) -> pa.RecordBatch:
        take = pa.array(row.astype(np.int64))
        arrays = [rows.column(c).combine_chunks().take(take) for c in ("doc_id", "mark")]
        arrays += [pa.nulls(len(row), t) if v is None else pa.array(v, t) for v, (_, t) in zip(columns, fields, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "mark", *[f for f, _ in fields]])

    kind = blocks.schema["doc_id"].dataType.simpleString()
    return blocks.mapInArrow(
        work, f"doc_id {kind}, mark long, first long, last long, left_hash long, right_hash long, open boolean")


def cut(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """``texts`` (doc_id, mark, body) without the byte ranges (doc_id, mark, low, high): kept bytes and removed runs."""
    lists = (ranges.groupBy(F.col("doc_id").alias("r_id"), F.col("mark").alias("r_mark"))
             .agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    joined = (texts.join(lists, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("mark") == F.col("r_mark")), "left")
              .select("doc_id", "body", "ranges"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, runs = [], []
            for body, found in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if not found.is_valid:
                    kept.append(body)
                    runs.append([])
                    continue
                low, high = (found.values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(low, kind="stable")
                low, reach = low[order], np.maximum.accumulate(high[order])
                new = np.flatnonzero(np.r_[True, low[1:] > reach[:-1]])
                low, high = low[new], np.r_[reach[new[1:] - 1], reach[-1]]
                pieces = zip(np.r_[0, high].tolist(), np.r_[low, len(body)].tolist(), strict=True)
                kept.append(b"".join(body[s:e] for s, e in pieces))
                runs.append([{"start": s, "end": e} for s, e in zip(low.tolist(), high.tolist(), strict=True)])
            spans = pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            sizes = pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(kept, pa.binary()), spans], names=["doc_id", "n_bytes", "kept", "spans"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(work, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")


def remove_repeats(docs: DataFrame, least: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte that a string of ``least`` bytes covers which also starts at any other place of the input.

    Strings are judged on the input, all their places go, and none crosses documents. Returns doc_id, n_bytes, kept
    (binary: a cut may fall inside a character) and spans (array of start and end of the maximal removed runs) for every
    row. Null texts are empty, texts shorter than ``least`` stay whole. Rows that repeat an id and a text are places of
    their own and so lose everything that is long enough; rows that share an id with other texts, and null ids, are
    documents like any other. An empty table gives an empty one; other columns are not read.
    """
    k = least // 4
    rows = documents_of(docs, id_col, text_col)
    texts = rows.select("doc_id", F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("body"))
    anchors = staged(anchor_rows(texts, least, k), "anchors")
    kinds = anchors.groupBy("gram", "body").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "mark", "p", "a", "b")).alias("one"))
    kinds = staged(kinds.join(
        kinds.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("kinds"), F.min("n").alias("fewest")), F.col("gram") == F.col("g")).drop("g")
        .filter("n > 1 OR kinds > 1"), "blocks")
    # blocks that stand at least twice: all their strings repeat
    twice = kinds.filter("n > 1").select(F.col("gram").alias("g"), F.col("body").alias("h"))
    whole = anchors.join(twice, (F.col("gram") == F.col("g")) & (F.col("body") == F.col("h"))).select("doc_id", "mark", F.col("a").alias("first"), F.col("b").alias("last"))
    # the others, and one of each block that they may share strings with
    rims = kinds.filter("kinds > 1 AND fewest = 1").select("n", "gram", "one.doc_id", "one.mark", "one.p", "one.a", "one.b")
    weight = F.sum(F.col("b") - F.col("a") + least)
    heavy = rims.groupBy(F.col("gram").alias("g")).agg(weight.alias("weight")).filter(F.col("weight") > BUCKET_BYTES)
    rims = rims.join(heavy, F.col("gram") == F.col("g"), "left").withColumn("heavy", F.col("weight").isNotNull())
    wanted = rims.groupBy(F.col("doc_id").alias("w_id"), F.col("mark").alias("w_mark")).agg(F.collect_list(F.struct("n", "gram", "heavy", "p", "a", "b")).alias("blocks"))
    at = F.col("at")
    blocks = staged(
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("mark") == F.col("w_mark")))
        .select("doc_id", "mark", "body", F.explode("blocks").alias("at"))
        .select("doc_id", "mark", at["p"].alias("p"), at["a"].alias("a"), at["b"].alias("b"), at["n"].alias("n"), at["gram"].alias("gram"),
                at["heavy"].alias("heavy"),
                F.substring(F.col("body"), (at["a"] + 1).cast("int"), (at["b"] - at["a"] + least).cast("int")).alias("bytes")), "suffixes")
    size = blocks.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    buckets = min(MOST_BUCKETS, -(-size.bytes // BUCKET_BYTES))
    lead = F.substring(F.col("bytes"), (F.col("p") - F.col("a") + 1).cast("int"), F.lit(min(LEAD, k))).alias("lead")
    share = max(1, size.rows // max(1, SAMPLES * buckets))
    sample = blocks.filter(F.pmod(F.xxhash64("doc_id", "mark", "p"), F.lit(share)) == 0).select(lead, "gram", "mark", "p", "heavy")
    splitters = Splitters.of(sample.collect() if buckets > 1 else [], buckets)  # some SAMPLES rows for each bucket
    dealt = deal(blocks, splitters, k).repartition(max(1, buckets), "bucket").sortWithinPartitions("bucket", lead, "gram", "mark", "p")
    found = staged(compare_buckets(dealt, least, k), "compared")
    inner = found.filter("left_hash IS NULL").select("doc_id", "mark", "first", "last")
    asked = found.filter("left_hash IS NOT NULL")
    shared = asked.groupBy(F.col("left_hash").alias("l"), F.col("right_hash").alias("r")).agg(F.count("*").alias("c")).filter("c > 1")
    across = (asked.filter("open").join(shared, (F.col("left_hash") == F.col("l")) & (F.col("right_hash") == F.col("r")))
              .select("doc_id", "mark", "first", "last"))
    strings = whole.unionByName(inner).unionByName(across)
    return cut(texts, strings.select("doc_id", "mark", F.col("first").alias("low"), (F.col("last") + least).alias("high")))
