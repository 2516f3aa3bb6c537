"""Repeated runs of lines found by winnowing, and deleted but for the first.

Windows begin and end at each line and hold as few lines as have
``least_words`` words. The fingerprint of a window is its least line hash with
the place of that line; any run of so many words holds a whole window, so
repeated runs share one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from taxaloom.llm.common import row_key, unused, whole_text
from taxaloom.session import cut

LEAST_WORDS = 50


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, body, line, k, hash, words, before): lines that are not blank.

    ``line`` counts all lines from 0, ``k`` those not blank; ``before`` are the
    words before it. Lines are compared without spaces at their ends.
    """
    split = docs.select(*row_key(id_col, text_col), F.posexplode(F.split(whole_text(text_col), "\n", -1)).alias("line", "raw"))
    trimmed = F.btrim("raw", F.lit(" \t\r\f\x0b"))
    lines = (
        split.select("id", "body", "line", trimmed.alias("raw")).filter("raw <> ''")
        .select("id", "body", "line", F.xxhash64("raw").alias("hash"),
                F.size(F.split("raw", r"[ \t]+", -1)).cast("long").alias("words"))
    )
    doc = Window.partitionBy("id", "body").orderBy("line")
    # A row given twice gives each line twice.
    once = lines.withColumn("again", F.lag("line").over(doc) == F.col("line")).filter("again IS NOT TRUE").drop("again")
    return once.withColumn("k", F.row_number().over(doc) - 1).withColumn(
        "before", F.sum("words").over(doc.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    )


def windows_of(lines: DataFrame, least_words: int) -> DataFrame:
    """(id, body, first, last, anchor, least, key) of all windows that have enough words.

    One begins at each line and one ends there, each with as few lines as will
    do. ``least`` is the least of its line hashes and ``anchor`` the place of
    it, the last of equal ones; ``key`` holds all hashes, so that equal keys are
    equal windows.
    """
    doc = Window.partitionBy("id", "body")
    frames = {
        1: doc.orderBy("before").rangeBetween(0, least_words - 1),
        -1: doc.orderBy("upto").rangeBetween(1 - least_words, 0),
    }
    parts = []
    for side, frame in frames.items():
        seen = lines.withColumn("upto", F.col("before") + F.col("words")).select(
            "id", "body", "k",
            F.collect_list("hash").over(frame).alias("hashes"), F.sum("words").over(frame).alias("words"),
            F.min(F.struct(F.col("hash"), (-F.col("k")).alias("place"))).over(frame).alias("least"),
        ).filter(F.col("words") >= least_words)
        other = F.col("k") + side * (F.size("hashes") - 1)
        parts.append(seen.select(
            "id", "body", F.least("k", other).alias("first"), F.greatest("k", other).alias("last"),
            (-F.col("least.place")).alias("anchor"), F.col("least.hash").alias("least"),
            F.xxhash64("least.hash", "hashes").alias("key"),
        ))
    return parts[0].unionByName(parts[1])


def repeated_runs(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, body, lines): the lines of each document that stand in a later run.

    Documents are ordered by id, null first, then by a hash of the text. The
    minima of the windows are the fingerprints: a run that stands twice has
    them twice, so windows whose minimum is that of one place alone are let go.
    The others meet their equals, and all but the first of equal windows repeat
    an earlier one. Every line of a repeated run is in a window of the run that
    begins or ends at some line of it: the windows that touch, each with an
    earlier one of its own, extend a match to both ends of the run, also where
    no single earlier document holds all of it. Each window has one partner,
    the first, however many copies there are, and no lines of a document travel
    to another.
    """
    lines = cut(lines_of(docs, id_col, text_col))
    windows = cut(windows_of(lines, least_words))
    places = windows.select("least", "id", "body", "anchor").distinct()
    shared = places.groupBy("least").agg(F.count("*").alias("places")).filter("places > 1").select("least")
    met = windows.join(shared, "least", "left_semi").select("key", "id", "body", "first", "last").distinct()
    start = F.struct("id", "body", "first")
    earliest = met.groupBy("key").agg(F.min(start).alias("start"), F.count("*").alias("n")).filter("n > 1")
    later = met.join(earliest.select("key", "start"), "key").filter(~start.eqNullSafe(F.col("start")))
    # Neighbours overlap: a run of windows gives its lines once.
    order = Window.partitionBy("id", "body").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = later.select("id", "body", F.greatest("first", F.coalesce(reached + 1, F.lit(0))).alias("first"), "last")
    found = fresh.filter("first <= last").select("id", "body", F.explode(F.sequence("first", "last")).alias("k"))
    numbered = lines.select("id", "body", "k", "line")
    of = [found["id"].eqNullSafe(numbered["id"]), found["body"] == numbered["body"], found["k"] == numbered["k"]]
    named = found.join(numbered, of[0] & of[1] & of[2]).select(numbered["id"], numbered["body"], "line")
    return named.groupBy("id", "body").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def dedup_lines(
    docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text",
    counter: str = "lines_deleted",
) -> DataFrame:
    """``docs`` without later repeats of runs of ``least_words`` words; all rows and columns stay.

    Adds their number as ``counter``. Lines are kept or deleted whole, also lines shorter
    than that within a run; blank lines stay. Null texts stay null, texts all
    of whose lines repeat become empty. Repeated rows are one document given
    more than once and get the same text. Columns of ``docs`` may have any
    names but ``counter``.
    """
    key, body, gone, of, of_body = unused(docs, "key", "body", "gone", "of", "of_body")
    runs = repeated_runs(docs, least_words, id_col, text_col).select(
        F.col("id").alias(of), F.col("body").alias(of_body), F.col("lines").alias(gone)
    )
    met = docs.select("*", *[c.alias(n) for c, n in zip(row_key(id_col, text_col), (key, body))])
    met = met.join(runs, F.col(key).eqNullSafe(F.col(of)) & (F.col(body) == F.col(of_body)), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    return met.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(gone), F.lit(0)).alias(counter),
    )
