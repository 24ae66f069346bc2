"""Near-duplicates by word shingles: SimHash and MinHash bands propose pairs, the shingles themselves decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.components import connected
from beaconry.llm.simhash import BITS, close_pairs
from beaconry.llm.support import LOWER, UPPER, bounded_batches, lean, staged

SEED = 42
WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 20, 5  # a pair at 0.8 shares none of its bands once in 2,800 times, a pair at 0.9 never in practice
NEAREST = 32  # shingles before a meeting point that are carried along, so that a pair meets once
CROWD = 2_000  # texts that have a shingle, above which chance brings some together first; either way all pairs are decided
HEAP, PROBES = 8, 6  # texts of such a heap, and how often they are dealt at most
SLACK = 1e-9  # of shares that are whole numbers but for rounding
MOST_SHINGLES = 1 << 12  # permuted at a time
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = np.random.default_rng(SEED + 1).integers(0, 1 << 63, size=(BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text; one of fewer words is one shingle, one without words has none."""
    raw = text.encode("utf-8").translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
    raw = b" ".join(raw.split())  # bytes split at exactly the space and the bytes 9 to 13
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    gaps = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(raw)]
    starts, ends = (starts[:len(starts) - width + 1], ends[width - 1:]) if len(starts) > width else (starts[:1], ends[-1:])
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends.tolist(), strict=True)
    return np.unique(np.fromiter((digest(raw[s:e], SEED) for s, e in pairs), dtype=np.uint64, count=len(starts)))


def band_keys(found: np.ndarray) -> list[int]:
    """A signed hash of each band of the text's least permuted shingles, the band's number included."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max)
    for at in range(0, len(found), MOST_SHINGLES):
        np.minimum(least, (found[at:at + MOST_SHINGLES] * FACTORS + OFFSETS).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(part.tobytes(), k) - (1 << 63) for k, part in enumerate(least.reshape(BANDS, ROWS))]


def simhash_of(found: np.ndarray) -> int:
    """The signed SimHash of a set of shingle hashes: bit by bit the strict majority."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(found), MOST_SHINGLES):
        hashes = found[at:at + MOST_SHINGLES].astype(">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found)).view(">i8")[0])


def print_of(text: Column, width: int) -> Column:
    """(fp, n, bits, keys): a hash of the shingles of a text, their number, SimHash and bands; zero and no band without shingles."""
    @F.pandas_udf("fp long, n long, bits long, keys array<long>")
    def column(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in lean(texts):
            rows = []
            for t in batch:
                found = shingles(t, width)
                whole = xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63) if len(found) else 0
                rows.append((whole, len(found), simhash_of(found), band_keys(found) if len(found) else []))
            yield pd.DataFrame(rows, columns=["fp", "n", "bits", "keys"])

    return column(text)


def set_of(text: Column, width: int) -> Column:
    @F.pandas_udf("binary")
    def column(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lean(texts):
            yield pd.Series([shingles(t, width).tobytes() for t in batch], dtype=object)

    return column(text)


def jaccard(one: Column, two: Column) -> Column:
    """Similarity of two sets of shingle hashes that are not both empty."""
    def share(a: bytes, b: bytes) -> float:
        a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / (len(a) + len(b) - both)

    @F.pandas_udf("double")
    def column(ones: pd.Series, twos: pd.Series) -> pd.Series:
        return pd.Series([share(a, b) for a, b in zip(ones, twos, strict=True)], dtype="float64")

    return column(one, two)


def alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets (fp, shingles) reach the similarity."""
    ours = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("one"))
    others = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("two"))
    return pairs.join(ours, "a").join(others, "b").filter(jaccard("one", "two") >= least).select("a", "b")


def may_be(least: float) -> Column:
    """Whether two sizes n and m allow the similarity."""
    return F.least("n", "m") / F.greatest("n", "m") >= least


def members_of(hashes: Column) -> Column:
    """A binary of 64-bit hashes as an array."""
    @F.pandas_udf("array<long>")
    def column(sets: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lean(sets):
            yield pd.Series([np.frombuffer(s, dtype=np.int64) for s in batch], dtype=object)

    return column(hashes)


def rare_prefixes(grouped: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(shingle, fp, n, at, before): the first of each set's shingles, rarest first, by which all similar sets meet.

    Shingles have one order, by how many of these sets have them and then by value. Of two sets of n <= m shingles with a
    similarity of ``least`` the first ``n - 2 least / (1 + least) n`` and one of the smaller hold one of the first
    ``m - least m`` and one of the larger: all that comes behind is too little for the overlap they need. What many sets
    have, a passage that stands in all of them, comes last and is no meeting point unless it is most of a set. ``before``
    has the nearest shingles before, as far as other sets have them: two sets that share one of these have met there.
    """
    each = grouped.join(sets, "fp").select("fp", "n", "root", F.explode(members_of(F.col("shingles"))).alias("shingle"))
    each = staged(each, "members")
    known = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"), F.min("root").alias("low"), F.max("root").alias("high"))
    in_order = Window.partitionBy("fp").orderBy("sets", "shingle")  # the shingles of one text
    placed = each.join(known, "shingle").withColumn("at", F.row_number().over(in_order))
    first = placed.filter((F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - SLACK) + 1) & (F.col("low") < F.col("high")))
    before = F.collect_list("shingle").over(Window.partitionBy("fp").orderBy("at").rowsBetween(-NEAREST, -1))
    return first.select("shingle", "fp", "n", "at", before.alias("before"))


def fit(least: float) -> Column:
    """Whether a pair that shares a shingle, at ``at_a`` of n and ``at_b`` of m, can reach the similarity by it and what follows."""
    left = F.least(F.col("n") - F.col("at_a"), F.col("m") - F.col("at_b")) + 1
    return (F.col("root_a") != F.col("root_b")) & may_be(least) & (left >= (F.col("n") + F.col("m")) * least / (1 + least) - SLACK)


def pair() -> list[Column]:
    return [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]


def crowds(first: DataFrame) -> DataFrame:
    """The rows of ``first`` at shingles that very many texts have, with the number of heaps these are dealt into."""
    large = first.groupBy("shingle").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CROWD)
    return first.drop("before").join(large.select("shingle", F.ceil(F.col("size") / HEAP).alias("heaps")), "shingle")


def probes(crowded: DataFrame, roots: DataFrame, least: float, number: int) -> DataFrame:
    """(a, b): pairs of different roots that chance brings together, a few for each text at every crowded shingle.

    The texts of a shingle are dealt at random into heaps of about ``HEAP``, and those of a heap meet.
    """
    dealt = crowded.join(roots, "fp").withColumn("heap", F.pmod(F.xxhash64("fp", "shingle", F.lit(number)), F.col("heaps")))
    one = dealt.select("shingle", "heap", F.col("fp").alias("a"), "n", F.col("at").alias("at_a"), F.col("root").alias("root_a"))
    two = dealt.select("shingle", "heap", F.col("fp").alias("b"), F.col("n").alias("m"), F.col("at").alias("at_b"), F.col("root").alias("root_b"))
    return one.join(two, ["shingle", "heap"]).filter((F.col("a") < F.col("b")) & fit(least)).select("a", "b").distinct()


def meeting(first: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """(a, b) of different roots that share a shingle of their prefixes, each pair once; no two of a shingle's largest root meet."""
    placed = first.join(roots, "fp")
    sizes = placed.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("shingle").agg(F.max(F.struct("size", "root"))["root"].alias("most"), F.count(F.lit(1)).alias("roots"))
    placed = staged(placed.join(largest.filter("roots > 1").drop("roots"), "shingle"), "prefixes")
    short = F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * least / (1 + least)) - SLACK) + 1
    shorter = placed.filter(short).select("shingle", F.col("fp").alias("a"), "n", F.col("at").alias("at_a"), F.col("root").alias("root_a"),
                                          F.col("before").alias("before_a"), (F.col("root") == F.col("most")).alias("usual_a"))
    longer = placed.select("shingle", F.col("fp").alias("b"), F.col("n").alias("m"), F.col("at").alias("at_b"), F.col("root").alias("root_b"),
                           F.col("before").alias("before_b"), (F.col("root") == F.col("most")).alias("usual_b"))
    in_order = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("a") < F.col("b")))
    here = in_order & fit(least) & ~F.arrays_overlap("before_a", "before_b")
    met = shorter.filter("NOT usual_a").join(longer, "shingle").filter(here).select("a", "b").unionByName(
        shorter.filter("usual_a").join(longer.filter("NOT usual_b"), "shingle").filter(here).select("a", "b"))
    return met.select(*pair()).distinct()


def simhash_pairs(nodes: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of nodes whose SimHashes differ in two bits at most, as far as their sizes allow the similarity.

    Prints meet by ``close_pairs``, each by the least of its nodes; the others of a print meet that one.
    """
    some = nodes.filter("n > 0")
    prints = some.groupBy("bits").agg(F.min(F.struct("fp", "n")).alias("low"))
    prints = staged(prints.select("bits", F.col("low.fp").alias("b"), F.col("low.n").alias("m")), "simhashes")
    same = some.select("bits", F.col("fp").alias("a"), "n").join(prints, "bits").select("a", "n", "b", "m")
    met = close_pairs(prints.select(F.col("bits").alias("fp"))).select(F.col("a").alias("one"), F.col("b").alias("two"))
    ones = prints.select(F.col("bits").alias("one"), F.col("b").alias("a"), F.col("m").alias("n"))
    twos = prints.select(F.col("bits").alias("two"), "b", "m")
    near = met.join(ones, "one").join(twos, "two").select("a", "n", "b", "m")
    return same.unionByName(near).filter((F.col("a") != F.col("b")) & may_be(least)).select(*pair()).distinct()


def similar_roots(nodes: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """(node, root) for the nodes (fp, n, bits, keys, id, mark) that are similar to another, over chains.

    SimHash brings those together that differ in two bits at most; of pairs near 0.8 most differ in more, so bands follow.
    First all texts of a band meet only its smallest and its largest: of a large group of near copies each costs two
    pairs a band. Texts of bands that then still hold several groups meet by their rarest shingles, see ``rare_prefixes``:
    where very many share one, first a few of them by chance, which joins most of a loose large group at a cost that grows
    with its texts; then all that are still of different groups. So in the end each similar pair of a band is linked, by itself or
    over others.
    """
    filed = nodes.select("fp", "n", F.explode("keys").alias("key"))
    ends = filed.groupBy("key").agg(F.min(F.struct("fp", "n")).alias("low"), F.max(F.struct("fp", "n")).alias("high")).filter("low.fp < high.fp")
    filed = staged(filed.join(ends, "key"), "bands")
    far = [filed.select(F.col("fp").alias("a"), "n", F.col(f"{end}.fp").alias("b"), F.col(f"{end}.n").alias("m")) for end in ("low", "high")]
    first = far[0].unionByName(far[1]).filter((F.col("a") != F.col("b")) & may_be(least))
    close = staged(simhash_pairs(nodes, least), "simhash_pairs")
    first = staged(first.select(*pair()).unionByName(close).distinct(), "pairs")
    named = filed.select("fp").unionByName(close.select(F.explode(F.array("a", "b")).alias("fp")))
    wanted = named.distinct().join(nodes.select("fp", "id", "mark"), "fp")
    held = texts.join(wanted, texts["text_id"].eqNullSafe(wanted["id"]) & (texts["text_mark"] == wanted["mark"]))
    held = held.dropDuplicates(["fp"])  # a repeated row is one text
    sets = staged(held.select("fp", set_of(F.col("text"), width).alias("shingles")), "shingles")
    links = staged(alike(first, sets, least), "near")
    roots = connected(links)
    placed = filed.join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", "n", F.coalesce("root", "fp").alias("root"))
    placed = staged(placed, "placed")
    open_ = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    grouped = staged(placed.join(open_, "key", "left_semi").select("fp", "n", "root").distinct(), "open")
    prefixes = staged(rare_prefixes(grouped, sets, least), "rare")
    found = grouped.select("fp", "root")
    crowded = staged(crowds(prefixes), "crowded")
    for number in range(PROBES if crowded.limit(1).count() else 0):
        tried = staged(probes(crowded, found, least, number).join(first, ["a", "b"], "left_anti"), "pairs")
        more = staged(alike(tried, sets, least), "near")
        if not more.limit(1).count():
            break
        first, links = first.unionByName(tried), links.unionByName(more)
        roots = connected(links)
        found = staged(grouped.select("fp").join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")), "open")
    rest = meeting(prefixes, found, least).join(first, ["a", "b"], "left_anti")
    more = staged(alike(staged(rest, "pairs"), sets, least), "near")
    return connected(links.unionByName(more)) if more.limit(1).count() else roots


def one_of_each(docs: DataFrame, width: int = WIDTH, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay of each group of near copies: the one with the smallest id.

    Two texts are near copies when the sets of their ``width``-word shingles have a Jaccard similarity of ``least`` or
    more; groups are linked over chains. Texts lose the case of A-Z only; words are runs without the space and the
    characters 9 to 13. A text of fewer words is one shingle; null texts and those without words are copies of each
    other. Candidates have SimHashes of their shingles that differ in two bits at most, or agree on one of ``BANDS`` bands of
    ``ROWS`` MinHashes; all are verified over their whole sets of 64-bit shingle hashes. Equal sets are folded to one first. A repeated id stays once; of a group without any id one
    row stays. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # a row travels as one value, so its columns may have any names
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text).alias("row_mark"), text.alias("text"), F.struct(*docs.columns).alias("row"))
    prints = rows.select(F.col("row_id").alias("id"), F.col("row_mark").alias("mark"), print_of(F.col("text"), width).alias("p"))
    marked = staged(prints.select("id", "mark", "p.fp", "p.n", "p.bits", "p.keys"), "prints")
    nodes = marked.groupBy("fp").agg(F.min(F.struct("id", "mark")).alias("at"), F.min("n").alias("n"), F.first("bits").alias("bits"), F.first("keys").alias("keys"))
    nodes = staged(nodes.select("fp", "n", "bits", "keys", "at.id", "at.mark"), "nodes")
    texts = rows.select(F.col("row_id").alias("text_id"), F.col("row_mark").alias("text_mark"), "text")
    roots = similar_roots(nodes, texts, width, least)
    grouped = marked.select("id", "mark", "fp").join(roots, F.col("fp") == F.col("node"), "left")
    stays = (grouped.groupBy(F.coalesce("root", "fp").alias("root"))
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("s"))
             .select(F.col("s.id").alias("stays"), F.col("s.mark").alias("stays_mark")))
    named = rows.drop("text").join(stays, F.col("row_id").eqNullSafe(F.col("stays")) & (F.col("row_mark") == F.col("stays_mark")))
    return named.dropDuplicates(["row_id", "row_mark"]).select("row.*")
