"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.components import connected
from beaconry.llm.support import LOWER, UPPER, documents_of, lean, staged

SEED = 42
BITS, BLOCK = 64, 16
MOST_SHINGLES = 1 << 16  # hashed at a time, so that a very long text needs no more memory than a long one


def fingerprint(text: str, width: int = 3) -> int:
    """The signed 64-bit SimHash of a text: bit by bit the strict majority over the hashes of its word shingles."""
    raw = text.encode("utf-8").translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
    raw = b" ".join(raw.split())  # bytes split at exactly the space and the bytes 9 to 13
    if not raw:
        return 0
    gaps = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(raw)]
    if len(starts) > width:
        starts, ends = starts[:-(width - 1)] if width > 1 else starts, ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), MOST_SHINGLES):
        pairs = zip(starts[at:at + MOST_SHINGLES].tolist(), ends[at:at + MOST_SHINGLES].tolist(), strict=True)
        hashes = np.array([digest(raw[s:e], SEED) for s, e in pairs], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts)).view(">i8")[0])


def fingerprint_of(text: Column, width: int = 3) -> Column:
    """The SimHash of a text column as a long."""
    @F.pandas_udf("long")
    def column(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lean(texts):
            yield pd.Series([fingerprint(t, width) for t in batch], dtype="int64")

    return column(text)


def close_pairs(prints: DataFrame) -> DataFrame:
    """(a, b) for all pairs of the distinct fingerprints ``fp`` that differ in one or two bits.

    A fingerprint has four blocks of 16 bits; a segment is the three blocks that are left when one is dropped. Two
    fingerprints with at most two differing bits either agree on a whole segment, or differ in one bit of block d and
    one of block c: then, with d dropped, their segments differ in that single bit of c. So each fingerprint is filed
    once under each of its four segments, and asks for these and for the segments with one bit of c set, for the six
    pairs d < c; only the one of two that has the bit unset needs to ask. At most 65,536 fingerprints can share a
    segment, whatever the size of the corpus, and all matches are verified over the whole 64 bits.
    """
    signed = lambda v: v - (1 << BITS) if v >> (BITS - 1) else v
    block = lambda k: ((1 << BLOCK) - 1) << (BLOCK * k)
    keep = [signed(~block(d) & ((1 << BITS) - 1)) for d in range(4)]
    mark = [signed((d + 1) << (BLOCK * d)) for d in range(4)]
    own = [F.col("fp").bitwiseAND(F.lit(keep[d])).bitwiseOR(F.lit(mark[d])) for d in range(4)]
    filed = prints.select(F.col("fp").alias("b"), F.explode(F.array(*own)).alias("key"))
    flips = [(d, signed(1 << (BLOCK * c + i))) for d in range(4) for c in range(d + 1, 4) for i in range(BLOCK)]
    asked = [F.when(F.col("fp").bitwiseAND(F.lit(bit)) == 0, own[d].bitwiseOR(F.lit(bit))) for d, bit in flips]
    asking = prints.select(F.col("fp").alias("a"), F.explode(F.array(*own, *asked)).alias("key")).filter("key IS NOT NULL")
    near = asking.join(filed, "key").filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def print_components(marked: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``marked`` (doc_id, fp)."""
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    roots = connected(close_pairs(prints.select("fp")))
    joined = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return joined.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SimHash every whole text and link fingerprints that differ in at most two bits.

    Returns doc_id, fingerprint (16 lower-case hex digits) and component_id (the smallest doc_id that can be reached
    over links) for every row. Texts lose the case of A-Z only; words are runs without the space and the characters 9
    to 13. A text of fewer than ``width`` words is one shingle; null texts and those without words have fingerprint
    zero and link like any other. Equal fingerprints, repeated rows among them, share a component. Null ids never name
    a component; one of null ids alone has a null component_id. An empty table gives an empty one. Copies are folded
    to one row for each fingerprint before pairs are sought, and no pair of documents is ever listed.
    """
    rows = documents_of(docs, id_col, text_col)
    marked = staged(rows.select("doc_id", fingerprint_of(F.col("text"), width).alias("fp")), "fingerprints")
    found = print_components(marked)
    return marked.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
