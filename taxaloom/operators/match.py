"""Match stages on keys.

Both sides are reduced to distinct keys first, so a name that fills a third of
the input, or a canonical form that fills a third of the records, is one row
here. A stage proposes probes ``(stage, kept, probe)`` as an array column;
``kept`` is the number of words kept. Probing records returns hits ``(match_key, matched_key, stage, kept, probe, stem_edit_distance)``.
Stages are numbered in the order in which they may claim a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from taxaloom.functions.names import cleaned, stemmed
from taxaloom.operators.fuzzy import spread_stems, stem_neighbours
from taxaloom.session import cut

EXACT, STEM, FUZZY, PARTIAL, PARTIAL_FUZZY, GENUS_PART = range(6)


def candidates(keys: DataFrame, *probes: Column) -> DataFrame:
    """One row per element of the arrays ``probes``, see below."""
    return keys.select("match_key", F.inline(F.concat(*probes)))


def _probe(stage: int, kept: Column, probe: Column) -> Column:
    return F.struct(F.lit(stage).alias("stage"), kept.alias("kept"), probe.alias("probe"))


def _when(condition: Column, probes: Column) -> Column:
    return F.when(condition, probes).otherwise(F.slice(probes, 1, 0))


def exact_probes(species_group: bool = False) -> Column:
    """The key itself and, for a species group, its autonym or species."""
    size = F.col("cardinality")
    itself = F.array(_probe(EXACT, size, F.col("match_key")))
    if not species_group:
        return itself
    first, second = F.try_element_at("epithets", F.lit(1)), F.try_element_at("epithets", F.lit(2))
    autonym = F.array(_probe(EXACT, size, F.concat_ws(" ", "match_key", first)))
    species = F.array(_probe(EXACT, size, F.concat_ws(" ", "genus", first)))
    return F.concat(
        itself, _when(size == 2, autonym), _when((size == 3) & (first == second), species)
    )


def partial_probes(stage: int) -> Column:
    """What is left after dropping last or middle epithets, at least one kept."""
    epithets, last = F.col("epithets"), F.slice("epithets", -1, 1)
    lengths = F.when(F.size(epithets) > 1, F.sequence(F.lit(1), F.size(epithets) - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def rest(words: Column) -> Column:
        return _probe(stage, F.size(words) + 1, F.concat_ws(" ", "genus", words))

    ends = F.transform(lengths, lambda n: rest(F.slice(epithets, F.lit(1), n)))
    middles = F.transform(
        lengths, lambda n: rest(F.concat(F.slice(epithets, F.lit(1), n - 1), last))
    )
    return F.array_distinct(F.concat(ends, middles))


def genus_probes() -> Column:
    return _when(
        F.col("cardinality") > 1, F.array(_probe(GENUS_PART, F.lit(1), F.col("genus")))
    )


def stem_probes(stage: int, uninomials: bool = False) -> Column:
    size = F.col("cardinality")
    return _when(
        size >= (1 if uninomials else 2), F.array(_probe(stage, size, F.col("match_key")))
    )


def probe_keys(probes: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates that are a key of some record."""
    return probes.join(records, F.col("probe") == F.col("matched_key")).select(
        "match_key", "matched_key", "stage", "kept", "probe",
        F.lit(0).alias("stem_edit_distance"),
    )


def _with_stem(probes: DataFrame) -> DataFrame:
    # Never null, so joins on it need no null filter that stems once more.
    return probes.withColumn("stem", F.coalesce(stemmed(F.col("probe")), F.lit("")))


def probe_stems(probes: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates whose stem is that of another canonical form."""
    stems = _with_stem(probes)
    same_stem = F.col("stem") == F.col("matched_stem")
    return stems.join(records, same_stem & (F.col("probe") != F.col("matched_key"))).select(
        "match_key", "matched_key", "stage", "kept", "probe",
        F.lit(0).alias("stem_edit_distance"),
    )


def record_traces(records: DataFrame, relaxed: bool = False) -> DataFrame:
    """Distinct stems of the records, spread for the similarity join."""
    stems = records.filter(F.col("matched_cardinality") > 0).select("matched_stem").distinct()
    return spread_stems(stems, "matched_stem", 2 if relaxed else 1)


def probe_similar(
    probes: DataFrame,
    records: DataFrame,
    relaxed: bool = False,
    traces: DataFrame | None = None,
) -> DataFrame:
    """Candidates with a stem close to that of a record.

    The similarity join sees distinct stems only; keys are attached after it.
    """
    stems = _with_stem(probes)
    close = stem_neighbours(
        stems.select("stem").distinct(),
        traces if traces is not None else record_traces(records, relaxed),
        distance=2 if relaxed else 1,
        guard_short_words=not relaxed,
    )
    return (
        stems.join(close, "stem")
        .join(records, "matched_stem")
        .select("match_key", "matched_key", "stage", "kept", "probe", "stem_edit_distance")
    )


def longest_first(hits: DataFrame) -> DataFrame:
    """Per key, the hits of its earliest stage with the longest remainder.

    A key has a bounded number of hits (stages, remainders, spellings), so
    the window groups stay small whatever the data.
    """
    order = W.partitionBy("match_key").orderBy("stage", F.desc("kept"))
    return hits.withColumn("_place", F.rank().over(order)).filter("_place = 1").drop("_place")


def labelled(hits: DataFrame, relaxed: bool = False) -> DataFrame:
    """Hits as matches: match type and distances in place of stage numbers."""
    stage = F.col("stage")
    suffix = "Relaxed" if relaxed else ""
    match_type = (
        F.when(F.col("match_key").startswith("virus:"), "Virus")
        .when(stage == EXACT, "Exact")
        .when(stage == STEM, "Fuzzy")
        .when(stage == FUZZY, "Fuzzy" + suffix)
        .when(stage == PARTIAL_FUZZY, "PartialFuzzy" + suffix)
        .otherwise("Partial")
    )
    typed = hits.select(
        "match_key",
        "matched_key",
        F.struct(
            "stem_edit_distance",
            F.levenshtein("probe", "matched_key").alias("edit_distance"),
            match_type.alias("match_type"),
        ).alias("hit"),
    )
    # Several remainders of a name can reach one form: the nearest is its match.
    nearest = typed.groupBy("match_key", "matched_key").agg(F.min("hit").alias("hit"))
    return nearest.select(
        "match_key", "matched_key", "hit.match_type", "hit.edit_distance", "hit.stem_edit_distance"
    )


def match_exact_string(names: DataFrame, records: DataFrame) -> DataFrame:
    """Every record whose name-string is that of an input row, but for white space.

    Distinct strings meet the records first; the pairs are stored, so that rows
    of a hot string can be split when they join them.
    """
    rows = names.withColumn("string", cleaned(F.col("name"))).filter("string <> ''")
    held = records.withColumnsRenamed({"name": "matched_name"}).withColumn("string", cleaned(F.col("matched_name")))
    found = cut(held.join(rows.select("string").distinct(), "string"))
    return rows.join(found, "string").drop("string").withColumns({
        "match_type": F.lit("Exact"), "edit_distance": F.lit(0), "stem_edit_distance": F.lit(0),
    })


def match_exact_canonical(keys: DataFrame, records: DataFrame) -> DataFrame:
    named = keys.filter(F.col("cardinality") > 0)
    return labelled(probe_keys(candidates(named, exact_probes()), records))


def match_virus(keys: DataFrame, records: DataFrame) -> DataFrame:
    viruses = keys.filter(F.col("match_key").startswith("virus:"))
    return labelled(probe_keys(candidates(viruses, exact_probes()), records))


def match_species_group(keys: DataFrame, records: DataFrame) -> DataFrame:
    named = keys.filter(F.col("cardinality") > 0)
    return labelled(probe_keys(candidates(named, exact_probes(species_group=True)), records))


def match_stem(keys: DataFrame, records: DataFrame) -> DataFrame:
    return labelled(probe_stems(candidates(keys, stem_probes(STEM)), records))


def match_fuzzy(keys: DataFrame, records: DataFrame) -> DataFrame:
    return labelled(probe_similar(candidates(keys, stem_probes(FUZZY)), records))


def match_fuzzy_relaxed(keys: DataFrame, records: DataFrame) -> DataFrame:
    hits = probe_similar(candidates(keys, stem_probes(FUZZY)), records, relaxed=True)
    return labelled(hits, relaxed=True)


def match_fuzzy_uninomial(keys: DataFrame, records: DataFrame) -> DataFrame:
    single = keys.filter(F.col("cardinality") == 1)
    probes = stem_probes(FUZZY, uninomials=True)
    return labelled(probe_similar(candidates(single, probes), records))


def match_partial(keys: DataFrame, records: DataFrame) -> DataFrame:
    found = probe_keys(candidates(keys, partial_probes(PARTIAL)), records)
    return labelled(longest_first(found))


def match_partial_fuzzy(
    keys: DataFrame, records: DataFrame, relaxed: bool = False
) -> DataFrame:
    found = probe_similar(candidates(keys, partial_probes(PARTIAL_FUZZY)), records, relaxed)
    return labelled(longest_first(found), relaxed)


def match_partial_fuzzy_relaxed(keys: DataFrame, records: DataFrame) -> DataFrame:
    return match_partial_fuzzy(keys, records, relaxed=True)


def match_genus_part(keys: DataFrame, records: DataFrame) -> DataFrame:
    return labelled(probe_keys(candidates(keys, genus_probes()), records))


def match_cascade(
    keys: DataFrame,
    records: DataFrame,
    species_group: bool = False,
    relaxed: bool = False,
    uninomials: bool = False,
    traces: DataFrame | None = None,
    stems: DataFrame | None = None,
) -> DataFrame:
    """Matches of the first stage that finds anything, for every key.

    Stages without a similarity join are one equi-join on all their probes at
    once. Only keys that neither their own form nor its stem settles go through
    the similarity join, and among these only keys without a partial match
    bring their remainders. A key is left to the earliest stage that found it,
    as if found names had left after each stage. ``traces`` and ``stems``, the
    records' keys by their stem, come from a stored index, together with its
    ``records``.
    """
    keys, records = cut(keys), records if traces is not None else cut(records)
    stems = records if stems is None else stems
    probes = candidates(
        keys, exact_probes(species_group), partial_probes(PARTIAL), genus_probes()
    )
    by_stem = candidates(keys, stem_probes(STEM))
    direct = cut(
        longest_first(probe_keys(probes, records).unionByName(probe_stems(by_stem, stems)))
    )
    rest = keys.join(direct.filter(F.col("stage") <= STEM), "match_key", "left_anti")
    without_part = rest.join(direct.filter(F.col("stage") == PARTIAL), "match_key", "left_anti")
    unsettled = candidates(rest, stem_probes(FUZZY, uninomials)).unionByName(
        candidates(without_part, partial_probes(PARTIAL_FUZZY))
    )
    similar = probe_similar(unsettled, stems, relaxed, traces)
    return labelled(longest_first(direct.unionByName(similar)), relaxed)
