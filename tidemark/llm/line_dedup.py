"""Removal of passages that repeat: overlapping windows of three lines. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name

WINDOW = 3


def line_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, pos, h1, h2): every window of three consecutive lines, hashed to 96 bits.

    Only hashes leave the scan, never text. A window of three blank lines says nothing and is
    left out. (The outer form of the explosion keeps the optimizer from computing the hashes a
    second time for a filter on empty arrays.)
    """
    lines = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.split(F.col(text), "\n", -1).alias("lines"),
    ).filter(F.size("lines") >= WINDOW)
    at = F.expr(
        f"transform(slice(lines, 1, greatest(size(lines) - {WINDOW - 1}, 0)), (l, i) -> if("
        "trim(l) = '' and trim(lines[i + 1]) = '' and trim(lines[i + 2]) = '', null, "
        "struct(xxhash64(l, lines[i + 1], lines[i + 2]) as h1, hash(l, lines[i + 1], lines[i + 2]) as h2)))"
    )
    hashed = lines.select("id", "text_hash", at.alias("windows"))
    return (
        hashed.select("id", "text_hash", F.posexplode_outer("windows").alias("pos", "w"))
        .filter(F.col("w").isNotNull())
        .select("id", "text_hash", "pos", F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    )


def repeated_windows(windows: DataFrame) -> DataFrame:
    """(h1, h2, first): windows at two places or more, and the first place.

    The aggregate combines in every map task, so a window that a third of all documents hold
    sends one row per task.
    """
    place = F.struct("id", "text_hash", "pos")
    return (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select("h1", "h2", "first")
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``n_lines``, ``n_removed`` (long).

    Lines end at ``\\n``. The first occurrence of a window, in the order of (doc_id, hash of the
    text, position), stays; every line that a later occurrence covers goes, and overlapping
    occurrences merge. No document is dropped; one whose lines all repeat gets an empty text.
    A null text stays null with no lines. A null doc_id sorts first. Rows of equal doc_id and
    text are one document: each of them gets the same result. Texts of fewer than three lines
    stay. Other columns pass through; if ``n_lines`` or ``n_removed`` exists, an underscore is
    added to the new name.

    The repeated windows are checkpointed, so both sides of the join that finds later
    occurrences are plain shuffles and AQE splits a hot window. A text is shuffled once, to
    meet its marks.
    """
    windows = line_windows(docs, doc_id, text)
    firsts = cut(repeated_windows(windows))
    place = F.struct("id", "text_hash", "pos")
    marks = (
        windows.join(firsts, ["h1", "h2"])
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set("pos")).alias("marks"))
    )
    return cut_marked(docs, marks, doc_id, text)


def cut_marked(docs: DataFrame, marks: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Cut the lines that the windows starting at ``marks`` cover; linear in lines and marks."""
    names = docs.columns
    mark = marks.select(
        F.col("id").alias(free_name("mark_id", names)),
        F.col("text_hash").alias(free_name("mark_hash", names)),
        F.col("marks").alias(free_name("mark_starts", names)),
    )
    id_, hash_, starts = mark.columns
    n_lines = free_name("n_lines", names)
    n_removed = free_name("n_removed", [*names, n_lines])
    lines = free_name("all_lines", names)
    kept = free_name("kept_lines", names)
    joined = docs.join(
        mark,
        docs[doc_id].eqNullSafe(mark[id_]) & (F.xxhash64(docs[text]) == mark[hash_]),
        "left",
    ).withColumn(lines, F.split(F.col(text), "\n", -1))
    # The stretch before each mark, and the one after the last, stay.
    stretches = F.expr(
        f"flatten(transform(concat(`{starts}`, array(size(`{lines}`))), (m, i) -> slice(`{lines}`, "
        f"if(i = 0, 0, `{starts}`[i - 1] + {WINDOW}) + 1, "
        f"greatest(m - if(i = 0, 0, `{starts}`[i - 1] + {WINDOW}), 0))))"
    )
    size = F.coalesce(F.size(lines), F.lit(0))
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(size).cast("long")
    marked = F.col(starts).isNotNull()
    result = joined.withColumn(kept, F.when(marked, stretches)).select(
        *[
            F.when(marked, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(c)
            if c == text
            else F.col(f"`{c}`")
            for c in names
        ],
        n.alias(n_lines),
        F.when(marked, n - F.size(kept)).otherwise(F.lit(0)).cast("long").alias(n_removed),
    )
    return result
