"""Similarity join of distinct stems.

Two strings within edit distance d become equal after at most d deletions on
each side. For distance 1 every stem is spread over the strings left by up to
one deletion, and stems meet in an equi-join on a hash of those. Stems that
share such a string differ from it by one insertion at most, so the size of a
join group is bounded by the alphabet and the length of a stem, not by the data.

For distance 2 that would take about n^2 / 2 strings. But of two halves of a
stem one holds one edit at most. So records are spread over the strings left by
up to one deletion in either half, and inputs over those of their beginnings
and ends that may be such a half: about n and 5 n strings. Half a stem is often
no more than a genus, which may have any number of species; a string that more
than ``CROWDED`` stems of records share is therefore no key. Stems that come
to such a string, and only these, meet on all their strings of two deletions,
where a common genus alone brings no two stems together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.session import cut

SHORTEST_FUZZY_WORD = 5
CROWDED = 256  # stems of records on one string of a half


def _spread_out(stems: DataFrame, column: str) -> DataFrame:
    """Distinct stems in many small partitions, before each gives many rows.

    They are made by a hash of the stem: by the stem itself they would count as
    those of the aggregate before, which are merged when small.
    """
    parts = int(stems.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stems.repartition(parts, F.xxhash64(column))


def _trace(kind: str, column: str, rest: str) -> str:
    """Hash of a string that is left; stems of unlike numbers of words never meet."""
    words = f"length(`{column}`) - length(replace(`{column}`, ' ', ''))"
    return f"xxhash64('{kind}', {words}, {rest})"


def _without_one(text: str) -> str:
    """``text`` without its letter number ``_i``; whole for 0."""
    return f"if(_i = 0, {text}, concat(substring({text}, 1, _i - 1), substring({text}, _i + 1)))"


def deletions(stems: DataFrame, column: str, distance: int) -> DataFrame:
    """Add ``trace``: a hash for each way to delete up to ``distance`` letters."""
    text = f"`{column}`"
    spread = _spread_out(stems, column).select("*", F.expr(f"explode(sequence(0, length({text}))) AS _i"))
    if distance == 1:
        rest = _without_one(text)
    elif distance == 2:
        # _j = _i deletes one letter only; _i = 0 deletes none.
        spread = spread.select(
            "*", F.expr(f"explode(sequence(_i, if(_i = 0, 0, length({text})))) AS _j")
        )
        rest = (
            f"concat(substring({text}, 1, _i - 1), substring({text}, _i + 1, _j - _i - 1),"
            f" if(_j = _i, substring({text}, _i + 1), substring({text}, _j + 1)))"
        )
        rest = f"if(_i = 0, {text}, {rest})"
    else:
        raise ValueError("distance must be 1 or 2")
    return spread.withColumn("trace", F.expr(_trace("whole", column, rest))).drop("_i", "_j")


def half_deletions(stems: DataFrame, column: str, slack: int) -> DataFrame:
    """Add ``trace``: a hash for each way to delete up to one letter of a half.

    Halves of a record are its own (``slack`` 0). An input has every beginning
    and end that differs from its half by up to ``slack`` = 2 letters: a record
    within distance 2 has a length within 2, so its half within 1, and what the
    half is made from has one letter more or less.
    """
    text, n = f"`{column}`", f"length(`{column}`)"
    # Half of a stem of odd length is the longer one at its end.
    sizes = {"first": f"int({n} / 2)", "last": f"{n} - int({n} / 2)"}
    parts = ", ".join(
        f"transform(sequence(greatest(0, {size} - {slack}), least({n}, {size} + {slack})),"
        f" k -> struct('{side}' AS side, {piece} AS part))"
        for (side, size), piece in zip(
            sizes.items(), (f"substring({text}, 1, k)", f"substring({text}, {n} - k + 1, k)")
        )
    )
    spread = _spread_out(stems, column).select("*", F.expr(f"inline(concat({parts}))"))
    spread = spread.select("*", F.expr("explode(sequence(0, length(part))) AS _i"))
    trace = _trace("half", column, f"side, {_without_one('part')}")
    return spread.withColumn("trace", F.expr(trace)).drop("side", "part", "_i")


def spread_stems(stems: DataFrame, column: str, distance: int) -> DataFrame:
    """The traces on which stems of records meet inputs within ``distance``.

    For distance 2 rows without a stem name the crowded traces of halves.
    """
    if distance == 1:
        return deletions(stems, column, 1)
    halves = cut(half_deletions(stems.select(column), column, 0).distinct())
    crowded = cut(halves.groupBy("trace").count().filter(F.col("count") > CROWDED).select("trace"))
    sparse = halves.join(crowded, "trace", "left_anti")
    met = halves.join(crowded, "trace", "left_semi").select(column).distinct()
    marks = crowded.select(F.lit(None).cast("string").alias(column), "trace")
    found = sparse.select(column, "trace").unionByName(deletions(met, column, 2)).unionByName(marks)
    return found


def _probes(stems: DataFrame, record_traces: DataFrame, distance: int) -> DataFrame:
    """The traces of inputs that those of :func:`spread_stems` are made for."""
    if distance == 1:
        return deletions(stems, "stem", 1)
    halves = half_deletions(stems, "stem", 2)
    crowded = record_traces.filter("matched_stem IS NULL").select("trace")
    met = halves.join(crowded, "trace", "left_semi").select("stem").distinct()
    return halves.unionByName(deletions(met, "stem", 2))


def stem_neighbours(
    stems: DataFrame,
    record_traces: DataFrame,
    distance: int = 1,
    guard_short_words: bool = True,
) -> DataFrame:
    """Pairs ``(stem, matched_stem, stem_edit_distance)`` within ``distance``.

    Both sides hold distinct stems, those of the records spread already.
    Paired stems have the same number of words; with the guard, words that
    differ have at least five letters on both sides.
    """
    traces = _probes(stems, record_traces, distance)
    apart = F.expr(f"levenshtein(stem, matched_stem, {distance})")
    # Each stem gives many traces, so neither side is as small as the tables it is read from.
    pairs = (
        traces.hint("merge").join(record_traces, "trace")
        .filter(apart >= 0)
        .select("stem", "matched_stem")
        .distinct()
        .withColumn("stem_edit_distance", apart)
    )
    words, matched = F.split("stem", " "), F.split("matched_stem", " ")
    # Of one number of words but for equal hashes; written so that it is no join key of its own.
    pairs = pairs.filter(F.abs(F.size(words) - F.size(matched)) == 0)
    if not guard_short_words:
        return pairs

    def allowed(a, b):
        return (a == b) | (F.least(F.length(a), F.length(b)) >= SHORTEST_FUZZY_WORD)

    return pairs.filter(F.forall(F.zip_with(words, matched, allowed), lambda ok: ok))
