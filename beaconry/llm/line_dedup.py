"""Removal of repeated runs of lines by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.support import documents_of, staged

LEAST = 40  # characters: most single lines have them, mere words between full stops do not


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def minimal_windows(texts: DataFrame, least: int) -> DataFrame:
    """(doc_id, mark, start, end, one, two, print, at): the minimal windows of the lines of ``texts`` (doc_id, mark, text).

    A window is a run of lines with at least ``least`` characters, line breaks counted, that loses this when its last line
    goes (one window for each first line) or when its first line goes (one for each last line). one and two hash its
    lines; print is the least hash of a line in it and at that line's place, the leftmost of ties.
    """
    lines = texts.select("doc_id", "mark", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    line = F.trim("line")
    rows = (lines.select("doc_id", "mark", "pos", F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g"),
                         (F.length(line) + 1).cast("long").alias("size"))
            .repartition("doc_id", "mark").dropDuplicates(["doc_id", "mark", "pos"]))  # repeated rows are one document here
    doc = Window.partitionBy("doc_id", "mark")
    rows = rows.withColumn("upto", F.sum("size").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("before", F.col("upto") - F.col("size"))

    def windows(over: Window) -> DataFrame:
        low = F.min(F.struct("h", "pos")).over(over)
        return (rows.select("doc_id", "mark", F.min("pos").over(over).alias("start"), F.max("pos").over(over).alias("end"),
                            F.collect_list("h").over(over).alias("hs"), F.collect_list("g").over(over).alias("gs"), low.alias("low"),
                            (F.max("upto").over(over) - F.min("before").over(over)).alias("chars"))
                .filter(F.col("chars") >= least)
                .select("doc_id", "mark", "start", "end", F.xxhash64("hs").alias("one"), F.xxhash64("gs").alias("two"),
                        F.col("low.h").alias("print"), F.col("low.pos").alias("at")))

    forward = windows(doc.orderBy("before").rangeBetween(0, least - 1))
    return forward.unionByName(windows(doc.orderBy("upto").rangeBetween(1 - least, 0)))


def repeated_lines(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, mark, gone): the places of the lines that go from each document that loses any."""
    windows = staged(minimal_windows(texts, least), "windows")
    place = F.struct("doc_id", "mark", "at")
    twice = (windows.groupBy(F.col("print").alias("p")).agg(F.min(place).alias("first_place"), F.max(place).alias("last_place"))
             .filter(~F.col("first_place").eqNullSafe(F.col("last_place"))).select("p"))
    joined = windows.join(twice, F.col("print") == F.col("p")).drop("p", "print", "at")
    start = F.struct("doc_id", "mark", "start")
    firsts = (joined.groupBy(F.col("one").alias("o"), F.col("two").alias("t"))
              .agg(F.min(start).alias("first"), F.max(start).alias("final")).filter(~F.col("first").eqNullSafe(F.col("final"))))
    later = (joined.join(firsts, (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")))
             .filter(~start.eqNullSafe(F.col("first"))).select("doc_id", "mark", "start", "end"))
    doc = Window.partitionBy("doc_id", "mark")
    before = F.max("end").over(doc.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = later.withColumn("from", F.greatest("start", F.coalesce(before + 1, F.lit(0)))).filter(F.col("from") <= F.col("end"))
    return (fresh.select("doc_id", "mark", F.explode(F.sequence("from", "end")).alias("pos"))
            .groupBy("doc_id", "mark").agg(F.collect_list("pos").alias("gone")))


def without(text: Column, gone: Column) -> Column:
    """The text without the lines at the places ``gone``; unchanged where that is null."""
    def rest(lines: Column) -> Column:
        stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stays, lambda i: F.get(lines, i)), "\n")

    # the list of one holds the split lines, so that they are split once for each text and not for each line
    return F.when(gone.isNull(), text).otherwise(F.get(F.transform(F.array(split_lines(text)), rest), F.lit(0)))


def dedup_lines(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Delete the later occurrences of repeated runs of lines that have at least ``least`` characters.

    Lines are told apart by their text without outer spaces; documents are ordered by id. In every run of that size
    winnowing selects the line with the least hash, so two equal runs always share a selected line; only windows whose
    selected line stands at another place too are compared. Windows that match are joined with their neighbours, and a
    line goes when it lies in a minimal window that occurred before: at a smaller (id, line), ids that are null first.
    A run may overlap its own repetition, so a line that is repeated on and on leaves its first place only.

    Returns doc_id, text, n_lines, n_removed and gone (places of the deleted lines, null if none) for every row. A null
    or empty text is one empty line; runs below ``least`` stay, however often they occur. Rows that repeat an id and a
    text are one document and get the same result; rows of one id with different texts are ordered by a hash of the text.
    An empty table gives an empty one; other columns are not read.
    """
    rows = documents_of(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    found = repeated_lines(rows, least).select(F.col("doc_id").alias("g_id"), F.col("mark").alias("g_mark"), "gone")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("mark") == F.col("g_mark")), "left")
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    return joined.select("doc_id", without(F.col("text"), F.col("gone")).alias("text"), lines.cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), "gone")


def strip_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are but the text; rows that lose their last line go.

    n_chars, where there is such a column, is counted anew for rows whose text changed. Null and empty texts stay, rows
    that repeat an id and a text are one document, an empty table gives an empty one. Columns may have any names: a row
    travels as one value.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text).alias("row_mark"), text.alias("row_text"), F.struct(*docs.columns).alias("row"))
    found = repeated_lines(rows.select(F.col("row_id").alias("doc_id"), F.col("row_mark").alias("mark"), F.col("row_text").alias("text")), least)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("mark").alias("found_mark"), "gone")
    joined = rows.join(found, F.col("row_id").eqNullSafe(F.col("found_id")) & (F.col("row_mark") == F.col("found_mark")), "left")
    gone = F.col("gone")
    cut = joined.withColumn("kept", F.when(gone.isNotNull(), without(F.col("row_text"), gone)))
    stays = cut.filter(gone.isNull() | (F.trim(F.translate("kept", "\n", " ")) != ""))

    def value(name: str) -> Column:
        own, kind = F.col("row")[name], docs.schema[name].dataType
        if name == text_col:
            return F.coalesce(F.col("kept").cast(kind), own).alias(name)
        if name == "n_chars":
            return F.when(gone.isNotNull(), F.length("kept").cast(kind)).otherwise(own).alias(name)
        return own.alias(name)

    return stays.select(*map(value, docs.columns))
