"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of one Arrow batch, so that what a Python worker is handed at once does not grow with the length of texts.
ARROW_BYTES = 8 << 20
# Characters of one batch that a Python worker holds in expanded form at a time.
BATCH_CHARS = 1 << 20


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame, written as Parquet into the cluster's shared scratch folder and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_in_worker(key: str, make):
    """The object that ``make`` built for ``key`` in this Python worker; Spark hands one worker many tasks.

    Tasks unpickle their functions anew, so what shall outlive a task is held by the interpreter itself. Only caches of
    bounded size belong here; a task that lands in a new worker builds its own.
    """
    held = sys.__dict__.setdefault("_beaconry_kept", {})
    if key not in held:
        held[key] = make()
    return held[key]


def lean(batches: Iterator) -> Iterator:
    """The same batches, for a task that needs nothing kept: what is kept goes first, and what was freed is returned last.

    A Python worker outlives its tasks, and so would the memory that they no longer use.
    """
    if sys.__dict__.pop("_beaconry_kept", None) is not None:
        gc.collect()
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; everything else, other scripts' capitals too, stays."""
    return F.translate(text, UPPER, LOWER)


def whole_text(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes, unless it bounds them more tightly itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any frame that has these two columns, whatever else it has."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))


def slices(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a list that hold about ``most`` characters each; one longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text) + 16
    if start < len(texts):
        yield start, len(texts)
