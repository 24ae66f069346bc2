"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.support import staged

PIVOTS = 64
ROWS, ASKING = 4096, 1024  # rows and queries of a block
STEP = 64  # candidates that are evaluated between two looks at the bound


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where the vector is null or holds a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots, from whole numbers and so exact up to the root."""
    square = (vectors.astype(np.float64) ** 2).sum(axis=1)[:, None] + (pivots.astype(np.float64) ** 2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(square - 2 * (vectors.astype(np.float64) @ pivots.astype(np.float64).T), 0))


def best(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, table: np.ndarray, norms: np.ndarray,
         to_pivots: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a block for one query; ties to smaller ids.

    The triangle inequality bounds the distance from below by the largest difference of distances to a pivot, and so the
    inner product from above. Candidates are evaluated by falling bound until the k-th score lies above all that is left.
    """
    least = np.abs(table - to_pivots).max(axis=1) if table.shape[1] else np.zeros(len(ids))
    size = float((query.astype(np.float64) ** 2).sum())
    bound = (size + norms - least ** 2) / 2 + 1e-9 * (size + norms) + 0.5
    order = np.argsort(-bound, kind="stable")
    found: list[tuple[int, int]] = []
    for at in range(0, len(order), STEP):
        if len(found) >= k and bound[order[at]] < -found[k - 1][0]:
            break
        some = order[at:at + STEP]
        some = some[ids[some] != own]
        scores = vectors[some] @ query
        found = sorted([*found, *zip((-scores).tolist(), ids[some].tolist(), strict=True)])[:k]
    return [(-s, i) for s, i in found]


def packed(rows: DataFrame, block: str, pivots: dict[int, np.ndarray]) -> DataFrame:
    """One row for each block and dimension: ids, vectors and distances to the pivots as binary arrays."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        width = table.column("dim")[0].as_py()
        vectors = np.array(table.column("v").combine_chunks().flatten(), dtype=np.int64).reshape(table.num_rows, width)
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        near = distances(vectors, pivots[width])
        yield pa.RecordBatch.from_arrays(
            [pa.array([table.column(block)[0].as_py()], pa.int64()), pa.array([width], pa.int32()),
             *[pa.array([x.tobytes()], pa.binary()) for x in (ids, vectors, near)]], names=["block", "dim", "ids", "vectors", "near"])

    return rows.groupBy(block, "dim").applyInArrow(work, "block long, dim int, ids binary, vectors binary, near binary")


def top_k(rows: DataFrame, queries: Column, k: int, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int = PIVOTS) -> DataFrame:
    """For each row that ``queries`` picks, the k rows of highest integer inner product among all others.

    Components become floor(scale * x). Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id,
    and a query with fewer candidates has fewer rows. Vectors that are null or hold null or non-finite components take
    no part, nor do rows without an id; vectors of another length than the query's are no candidates of it. Repeated
    rows of one id and vector are one row; rows of the query's own id are never its candidates. Scores must fit a long.

    Rows and queries are dealt into blocks of bounded size; each pair of blocks is one unit of work that keeps k rows
    for each query. The pivots, at most ``pivots`` rows for each length, are those with the least hashes; distances to
    them are computed once, when a block is packed.
    """
    valid = (rows.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col), scale).alias("v"), queries.alias("asks"))
             .filter("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id", "v").agg(F.max("asks").alias("asks"))
             .withColumn("dim", F.size("v")))
    valid = staged(valid, "vectors")
    sizes = valid.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).collect()  # a row for each length
    n, q = sum(r.n for r in sizes), sum(r.q for r in sizes)
    picked = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "v"), "vec_id")
    few = valid.withColumn("nth", F.row_number().over(picked)).filter(F.col("nth") <= pivots).select("dim", "v").collect()
    chosen = {r.dim: np.array([x.v for x in few if x.dim == r.dim], dtype=np.int64).reshape(min(pivots, r.n), r.dim) for r in sizes}
    blocks, asking = max(1, -(-n // ROWS)), max(1, -(-q // ASKING))
    part = lambda m: F.pmod(F.xxhash64("vec_id", "v"), F.lit(m).cast("long"))
    table = staged(packed(valid.withColumn("b", part(blocks)), "b", chosen), "blocks")
    asked = staged(packed(valid.filter("asks").withColumn("b", part(asking)), "b", chosen), "queries")
    pairs = (table.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(asking - 1)))).repartition(blocks * asking, "block", "with")
             .join(asked.select(F.col("block").alias("asked"), F.col("dim").alias("width"), F.col("ids").alias("q_ids"),
                                F.col("vectors").alias("q_vectors"), F.col("near").alias("q_near")),
                   (F.col("with") == F.col("asked")) & (F.col("dim") == F.col("width"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                width, count = pair["dim"], len(chosen[pair["dim"]])
                ids, vectors, near, q_ids, q_vectors, q_near = (
                    np.frombuffer(pair[c], dtype=t).reshape(-1, w) for c, t, w in (
                        ("ids", np.int64, 1), ("vectors", np.int64, max(width, 1)), ("near", np.float64, max(count, 1)),
                        ("q_ids", np.int64, 1), ("q_vectors", np.int64, max(width, 1)), ("q_near", np.float64, max(count, 1))))
                ids = ids.ravel()
                if not width:
                    vectors, q_vectors = np.zeros((len(ids), 0), np.int64), np.zeros((len(q_ids), 0), np.int64)
                norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
                found = [(own, i, s) for own, query, to_pivots in zip(q_ids.ravel().tolist(), q_vectors, q_near, strict=True)
                         for s, i in best(query, own, ids, vectors, near, norms, to_pivots, k)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*found, strict=True) if found else ((), (), ()))],
                                                 names=["query_id", "vec_id", "score"])

    found = pairs.select("dim", "ids", "vectors", "near", "q_ids", "q_vectors", "q_near").mapInArrow(work, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
