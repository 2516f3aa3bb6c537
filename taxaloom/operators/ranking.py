"""Scoring, order and choice of the records of each name.

A canonical form may belong to a third of all records and of all names, so
names and records of a form are never paired off. The score of a pair depends
on the name only through rank and authorship. Records of a form are therefore
indexed by the ways in which a rank and an authorship can agree, the first
record (by the parts of the order that do not depend on the name) is kept for
each, and a name looks up the few entries that apply to it. The best record
is among them: in the entry that describes how it agrees with the name,
no record is placed before it.

Inputs that agree in match key, rank and authorship share a ``profile``; all
work is done once per profile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from taxaloom.functions.scores import (
    acceptance_score,
    curation_score,
    has_authorship,
    parse_quality_score,
    with_scores,
)
from taxaloom.operators.order import placed
from taxaloom.session import cut

# What tells records of one form apart when they are scored against a name.
RECORD_CLASS = ["matched_key", "matched_rank", "matched_authors_text", "matched_year"]
RECORD_SCORES = ["curation_score", "acceptance_score", "parse_quality_score"]
TIES = ["matched_name", "data_source_id", "record_id"]
ENTRIES = ["rank_entry", "authorship_entry"]
OPTIONAL = ["local_id", "entry_date", "classification_ids"]  # columns that records may lack


def name_profiles(prepared: DataFrame) -> DataFrame:
    return prepared.select(
        "profile",
        "match_key",
        F.col("cardinality").alias("name_cardinality"),
        F.col("rank").alias("name_rank"),
        F.col("authors_text").alias("name_authors_text"),
        F.col("year").alias("name_year"),
    ).distinct()


def attach_source(matches: DataFrame, data_sources: DataFrame) -> DataFrame:
    """Add title, curation and update date of the source."""
    about = data_sources.select(
        F.col("id").alias("data_source_id"),
        F.col("title_short").alias("data_source_title"),
        "curation",
        F.col("updated_at").cast("date").alias("updated_at"),
    )
    return matches.join(about, "data_source_id", "left").withColumn(
        "curation", F.coalesce("curation", F.lit("NotCurated"))
    )


def scored_records(prepared: DataFrame, data_sources: DataFrame) -> DataFrame:
    """Records in the columns ``matched_*`` with the scores that are theirs alone."""
    return attach_source(prepared, data_sources).select(
        F.col("match_key").alias("matched_key"),
        F.col("name").alias("matched_name"),
        F.col("canonical_full").alias("matched_canonical_full"),
        F.col("canonical_simple").alias("matched_canonical_simple"),
        F.col("cardinality").alias("matched_cardinality"),
        F.col("rank").alias("matched_rank"),
        F.col("authors_text").alias("matched_authors_text"),
        F.col("year").alias("matched_year"),
        "data_source_id",
        "data_source_title",
        "curation",
        "record_id",
        "current_record_id",
        "is_synonym",
        "classification_path",
        "classification_ranks",
        "outlink",
        *[F.col(c) if c in prepared.columns else F.lit(None).cast("string").alias(c) for c in OPTIONAL],
        curation_score().alias("curation_score"),
        acceptance_score().alias("acceptance_score"),
        parse_quality_score().alias("parse_quality_score"),
    )


def first_of(df: DataFrame, groups: list[str], order: list[Column]) -> DataFrame:
    """First row of each group. Tasks drop all other rows before the shuffle."""
    window = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def record_order() -> list[Column]:
    return [F.desc(c) for c in RECORD_SCORES] + [F.asc(c) for c in TIES]


def match_order() -> list[Column]:
    """Order of the records of one name: all components, then the ties."""
    return [F.desc("sort_score")] + [F.asc(c) for c in TIES]


def _entries(*pairs: tuple[Column, Column]) -> Column:
    """The values whose condition holds."""
    found = F.array(*[F.when(condition, value) for condition, value in pairs])
    return F.array_compact(found)


def _rank_of(prefix: str) -> Column:
    return F.concat(F.lit("rank:"), F.col(prefix + "rank"))


def _authors_of(prefix: str) -> Column:
    return F.concat(F.lit("authors:"), F.col(prefix + "authors_text"))


def _year_of(prefix: str) -> Column:
    return F.concat(F.lit("year:"), F.col(prefix + "year").cast("string"))


def _both_of(prefix: str) -> Column:
    return F.concat_ws("|", F.lit("both"), F.col(prefix + "authors_text"), F.col(prefix + "year"))


def _agreements(prefix: str) -> list[tuple[Column, Column]]:
    authors = F.col(prefix + "authors_text") != ""
    return [
        (F.lit(True), F.lit("any")),
        (authors, _both_of(prefix)),
        (authors, _authors_of(prefix)),
        (F.col(prefix + "year").isNotNull(), _year_of(prefix)),
    ]


def with_record_entries(classes: DataFrame) -> DataFrame:
    """One row per rank entry and authorship entry of a record class."""
    ranks = _entries(
        (F.lit(True), F.lit("any")), (F.col("matched_cardinality") > 2, _rank_of("matched_"))
    )
    known = F.when(has_authorship("matched_"), "some").otherwise("none")
    authorships = _entries(*_agreements("matched_"), (F.lit(True), known))
    return classes.withColumn("rank_entry", F.explode(ranks)).withColumn(
        "authorship_entry", F.explode(authorships)
    )


def with_name_entries(profiles: DataFrame) -> DataFrame:
    """One row per entry in which a profile looks for records."""
    ranked = F.col("name_rank") != ""
    ranks = _entries(
        (F.lit(True), F.lit("any")),
        (ranked, _rank_of("name_")),
        (ranked, F.lit("rank:")),
    )
    known = F.when(has_authorship("name_"), "none").otherwise("some")
    authorships = _entries(*_agreements("name_"), (F.lit(True), known))
    return profiles.withColumn("rank_entry", F.explode(ranks)).withColumn(
        "authorship_entry", F.explode(authorships)
    )


def record_index(records: DataFrame, per_source: bool = False) -> DataFrame:
    """The first record of each entry, or of each entry and source."""
    source = ["data_source_id"] if per_source else []
    classes = first_of(records, RECORD_CLASS + source, record_order())
    return first_of(
        with_record_entries(classes), ["matched_key", *ENTRIES, *source], record_order()
    )


def _matched(records: DataFrame, matches: DataFrame) -> DataFrame:
    return records.join(matches.select("matched_key"), "matched_key", "left_semi")


def _leading(
    profiles: DataFrame, matches: DataFrame, records: DataFrame,
    per_source: bool, index: DataFrame | None,
) -> DataFrame:
    """Scored records among which the first of each profile is found."""
    if index is None:
        # Stored, the index joins by its true size: sent to all tasks when small,
        # else shuffled with the probes, where a hot form is split among tasks.
        index = cut(record_index(_matched(records, matches), per_source))
    probes = with_name_entries(profiles.join(matches, "match_key"))
    return with_scores(probes.join(index, ["matched_key", *ENTRIES]))


def best_result(
    profiles: DataFrame, matches: DataFrame, records: DataFrame, index: DataFrame | None = None
) -> DataFrame:
    """The first record of each profile. ``index`` is a stored ``record_index``."""
    found = _leading(profiles, matches, records, False, index)
    return first_of(found, ["profile"], match_order())


def best_per_source(
    profiles: DataFrame, matches: DataFrame, records: DataFrame, index: DataFrame | None = None
) -> DataFrame:
    """The first record of each profile in each source."""
    found = _leading(profiles, matches, records, True, index)
    return first_of(found, ["profile", "data_source_id"], match_order())


def best_results(
    best: DataFrame, matches: DataFrame, records: DataFrame
) -> DataFrame:
    """All records that share the best score, where there are several.

    The score of the best record says which entry holds its equals, so they
    are found by an equi-join; what is joined is what is returned.
    """
    records = _matched(records, matches)
    counted = records.groupBy(*RECORD_CLASS, "matched_cardinality", *RECORD_SCORES).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    steps = F.round(F.col("authorship_score") * 21)
    rank_entry = F.when(F.col("rank_score") == 1, _rank_of("name_")).when(
        (F.col("rank_score") == 0.5) & (F.col("name_rank") != ""), "rank:"
    )
    authorship_entry = (
        F.when(steps == 21, _both_of("name_"))
        .when(steps == 15, _authors_of("name_"))
        .when(steps == 9, _year_of("name_"))
        .when(steps == 6, "some")
        .when((steps == 3) & has_authorship("name_"), "none")
    )
    tops = best.select(
        "profile", "match_key", "name_cardinality", "name_rank", "name_authors_text", "name_year",
        *RECORD_SCORES,
        F.col("sort_score").alias("best_score"),
        F.coalesce(rank_entry, F.lit("any")).alias("rank_entry"),
        F.coalesce(authorship_entry, F.lit("any")).alias("authorship_entry"),
    )
    tied = (
        with_scores(
            tops.join(matches, "match_key").join(
                with_record_entries(counted), ["matched_key", *ENTRIES, *RECORD_SCORES]
            )
        )
        .filter(F.col("sort_score") == F.col("best_score"))
        .drop("best_score", *ENTRIES)
    )
    several = tied.groupBy("profile").agg(F.sum("n_records").alias("n_tied")).filter("n_tied > 1")
    same = [*RECORD_CLASS, "matched_cardinality", *RECORD_SCORES]
    left, right = tied.drop("n_records").alias("tied"), records.alias("records")
    on = [F.col(f"tied.{c}").eqNullSafe(F.col(f"records.{c}")) for c in same]
    rest = [c for c in records.columns if c not in same]
    return (
        left.join(several, "profile", "left_semi")
        .alias("tied")
        .join(right, on)
        .select("tied.*", *[F.col(f"records.{c}") for c in rest])
    )


def all_matches(profiles: DataFrame, matches: DataFrame, records: DataFrame) -> DataFrame:
    """Every record of every profile. The output is as large as it has to be:
    the join is on the key alone, and each pair is a result."""
    return with_scores(profiles.join(matches, "match_key").join(records, "matched_key"))


def rank_results(results: DataFrame) -> DataFrame:
    """Add ``rn``, the place within the profile, whatever a profile holds.

    All results are numbered in one order, profile first, by ranges (see
    :func:`~taxaloom.operators.order.placed`), so a profile with a third of
    them spans many tasks. The place within a profile is the one among all,
    less that of the profile's first row.
    """
    numbered = placed(results, [F.asc("profile"), *match_order()])
    first = numbered.groupBy("profile").agg(F.min("place").alias("_first"))
    # As large as there are profiles, whatever the size of the stored columns it is read from.
    return numbered.join(first.hint("merge"), "profile").withColumn("rn", (F.col("place") - F.col("_first") + 1).cast("int")).drop(
        "place", "_first"
    )


def rank_per_source(results: DataFrame) -> DataFrame:
    """:func:`rank_results` for at most one result per profile and source: a
    profile has no more than there are sources, so a window holds few rows."""
    window = W.partitionBy("profile").orderBy(*match_order())
    return results.withColumn("rn", F.row_number().over(window))
