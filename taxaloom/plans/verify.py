"""Verification of a table of names against the records of all sources."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from taxaloom.operators import attach, match, prepare, ranking, results
from taxaloom.session import bucketed, cut


@dataclass(frozen=True)
class RecordIndex:
    """Records prepared once for many runs, such as the batches of a stream.

    All but the records themselves is stored in buckets of what it is joined
    on, so that a run shuffles its own names only.
    """

    prepared: DataFrame        # decomposed records
    keys: DataFrame            # distinct match keys, by key
    stems: DataFrame           # the same by stem
    traces: DataFrame          # their stems, spread for the similarity join
    entries: DataFrame         # first record per form and agreement, with its accepted name
    source_entries: DataFrame | None  # the same per source, for runs that choose sources
    held: DataFrame            # in which sources a form is
    relaxed: bool


def build_index(
    records: DataFrame, data_sources: DataFrame, relaxed: bool = False, by_source: bool = True
) -> RecordIndex:
    """Store what every run derives from the records alone; without ``by_source``
    not what only runs with sources look up."""
    prepared = cut(prepare.prepared_records(records))
    keys = cut(prepare.record_keys(prepared))
    scored = ranking.scored_records(prepared, data_sources)
    by_entry = ["matched_key", *ranking.ENTRIES]
    if by_source:
        # The first record of all sources is the first of the first records of each.
        per_source = cut(ranking.record_index(scored, per_source=True))
        best = ranking.first_of(per_source, by_entry, ranking.record_order())
        source_entries = bucketed(attach.resolve_current(per_source, prepared), *by_entry)
    else:
        best, source_entries = ranking.record_index(scored), None
    return RecordIndex(
        prepared=prepared,
        keys=bucketed(keys, "matched_key"),
        stems=bucketed(keys, "matched_stem"),
        traces=bucketed(match.record_traces(keys, relaxed), "trace"),
        entries=bucketed(attach.resolve_current(best, prepared), *by_entry),
        source_entries=source_entries,
        held=bucketed(scored.select("matched_key", "data_source_id").distinct(), "matched_key"),
        relaxed=relaxed,
    )


@dataclass(frozen=True)
class Verification:
    """Tables of one verification. Rows of the input meet them through ``profile``."""

    names: DataFrame      # decomposed input rows
    errors: DataFrame     # input rows that hold no name
    profiles: DataFrame   # distinct inputs
    matches: DataFrame    # match key -> keys of records
    records: DataFrame    # records with their own scores
    prepared_records: DataFrame
    sources: list[int] | str | None
    index: RecordIndex | None = None
    every: bool = False   # list all records of the chosen sources, not the best of each
    vernaculars: DataFrame | None = None
    languages: str | Iterable[str] | None = None

    def _resolved(self, found: DataFrame) -> DataFrame:
        """Matched records with their accepted names, which those of an index have already."""
        if "current_name" in found.columns:
            return found
        return attach.resolve_current(found, self.prepared_records)

    def _told(self, found: DataFrame) -> DataFrame:
        """Matched records with their accepted and common names."""
        return attach.with_vernaculars(self._resolved(found), self.vernaculars, self.languages)

    def _from_all(self) -> bool:
        """Whether records of all sources are listed, so that the best of all is among them."""
        return bool(self.sources) and prepare.filter_sources(self.records, self.sources) is self.records

    @cached_property
    def _firsts(self) -> DataFrame:
        """First record of each profile in each chosen source, stored for what is made of it."""
        return cut(self._per_source())

    def _best(self) -> DataFrame:
        if self._from_all() and not self.every:
            return ranking.first_of(self._firsts, ["profile"], ranking.match_order())
        entries = self.index.entries if self.index else None
        return ranking.best_result(self.profiles, self.matches, self.records, entries)

    def _per_source(self) -> DataFrame:
        chosen = prepare.filter_sources(self.records, self.sources)
        entries = None
        if self.index:
            entries = prepare.filter_sources(self.index.source_entries, self.sources)
        return ranking.best_per_source(self.profiles, self.matches, chosen, entries)

    def best(self) -> DataFrame:
        """First record of each profile, with its accepted name."""
        return self._told(self._best())

    def per_source(self) -> DataFrame:
        """First record of each profile in each chosen source."""
        return self._told(self._firsts if self._from_all() else self._per_source())

    def _ranked(self) -> DataFrame:
        """What is listed, with its place ``rn`` within the profile."""
        if not self.every:
            return ranking.rank_per_source(self._per_source())
        # Stored and dealt out with what flat rows show or need for it. Beside rows of an
        # index, which have accepted names, those of the records need them first.
        found = self.all_matches().drop(*results.ONLY_FOR_SCORES)
        return ranking.rank_results(self._resolved(found) if self.index else found)

    def all_matches(self) -> DataFrame:
        """Every record of the chosen sources, for each profile."""
        chosen = prepare.filter_sources(self.records, self.sources)
        return ranking.all_matches(self.profiles, self.matches, chosen)

    def listed(self) -> DataFrame | None:
        """What is listed after the best record: nothing without sources, else one
        record of each or, with ``every``, all."""
        if not self.sources:
            return None
        return self._told(self.all_matches()) if self.every else self.per_source()

    def tied(self) -> DataFrame:
        """All records that share the best score of a profile."""
        found = ranking.best_result(self.profiles, self.matches, self.records)
        return ranking.best_results(found, self.matches, self.records)

    def sources_num(self) -> DataFrame:
        return attach.sources_matched(self.matches, self.records, self.index.held if self.index else None)

    def per_row(self, found: DataFrame) -> DataFrame:
        """Results of profiles as results of input rows."""
        return self.names.select("row_id", "name", "profile").join(cut(found), "profile")

    def documents(self) -> DataFrame:
        """One document per input row, errors included."""
        nested = results.nest_results(
            self.names, self.best(), self.listed(), self.sources_num(), self._told(self.tied())
        )
        return results.with_errors(nested, self.errors)

    def flat(self) -> DataFrame:
        """The flat rows of the documents, without putting these together.

        The best and the listed results meet the records of accepted names together.
        Where all sources are listed, the first of a profile's rows is its best as well.
        """
        shown = replace(self, records=self.records.drop(*results.NOT_IN_FLAT))
        if not self.sources:
            placed = shown._best().withColumn("position", F.lit(0))
        elif self._from_all():
            twice = F.when(F.col("rn") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array("rn"))
            placed = shown._ranked().withColumn("position", F.explode(twice)).drop("rn")
        else:
            placed = shown._best().withColumn("position", F.lit(0)).unionByName(
                shown._ranked().withColumnRenamed("rn", "position"), allowMissingColumns=True
            )
        return results.flat_matches(self.names, self.errors, self._told(placed))


def verify(
    names: DataFrame,
    records: DataFrame | RecordIndex,
    data_sources: DataFrame,
    *,
    sources: list[int] | str | None = None,
    all_matches: bool = False,
    capitalize: bool = False,
    species_group: bool = False,
    relaxed: bool = False,
    uninomials: bool = False,
    vernaculars: DataFrame | None = None,
    languages: str | Iterable[str] | None = None,
) -> Verification:
    """Match ``names (row_id, name)`` to ``records`` and prepare their ranking.

    ``records`` are plain, or prepared by ``prepare.prepared_records`` and
    stored, or a whole index that several runs share. With ``sources``, ids or
    a comma-separated text of ids, the best record of each is listed after the
    best of all, with ``all_matches`` all of its records. ``vernaculars`` and
    ``languages`` give each record its common names.
    """
    index = records if isinstance(records, RecordIndex) else None
    if index and sources and index.source_entries is None:
        raise ValueError("this index was built without by_source")
    if index:
        relaxed, prepared = index.relaxed, index.prepared
    elif "match_key" in records.columns:
        prepared = records
    else:
        prepared = cut(prepare.prepared_records(records))
    rows = cut(prepare.prepared_names(names, capitalize).select(*prepare.NAME_COLUMNS))
    profiles = cut(ranking.name_profiles(rows))
    keys = prepare.name_keys(
        profiles.withColumnRenamed("name_cardinality", "cardinality")
    )
    matches = cut(
        match.match_cascade(
            keys,
            index.keys if index else prepare.record_keys(prepared),
            species_group,
            relaxed,
            uninomials,
            index.traces if index else None,
            index.stems if index else None,
        )
    )
    return Verification(
        names=rows,
        errors=prepare.error_rows(names),
        profiles=profiles,
        matches=matches,
        records=ranking.scored_records(prepared, data_sources),
        prepared_records=prepared,
        sources=sources,
        index=index,
        every=all_matches,
        vernaculars=vernaculars,
        languages=languages,
    )


def no_match_rows(names: DataFrame, matches: DataFrame) -> DataFrame:
    """Prepared names without any match."""
    missing = names.join(matches.select("match_key"), "match_key", "left_anti")
    return missing.select(
        "row_id",
        "name",
        F.lit("NoMatch").alias("match_type"),
        F.lit("NotCurated").alias("curation"),
    )


def map_checklist(
    names: DataFrame, records: DataFrame, data_sources: DataFrame, source: int, **options: bool
) -> DataFrame:
    """The best record of one source for each input row, whatever others hold."""
    only = prepare.filter_sources(records, [source])
    run = verify(names, only, data_sources, **options)
    return run.per_row(run.best())
