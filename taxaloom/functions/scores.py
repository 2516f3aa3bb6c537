"""Score components of a match and the sort score made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Components in the order in which they decide.
COMPONENTS = [
    "cardinality_score",
    "rank_score",
    "fuzzy_less_score",
    "curation_score",
    "authorship_score",
    "acceptance_score",
    "parse_quality_score",
]

STEPS = 21  # every component is a multiple of 1/21, but for the 1/2 of ranks


def has_authorship(prefix: str = "") -> Column:
    return (F.col(prefix + "authors_text") != "") | F.col(prefix + "year").isNotNull()


def curation_score(source: str = "data_source_id", curation: str = "curation") -> Column:
    return (
        F.when(F.col(source) == 1, 1.0)
        .when(F.col(curation) == "Curated", 2 / 3)
        .when(F.col(curation) == "AutoCurated", 1 / 3)
        .otherwise(0.0)
    )


def acceptance_score() -> Column:
    return F.when(F.col("is_synonym"), 0.0).otherwise(1.0)


def parse_quality_score(quality: str = "parse_quality") -> Column:
    q = F.col(quality)
    return F.when(q == 1, 1.0).when(q == 2, 2 / 3).when(q == 3, 1 / 3).otherwise(0.0)


def with_scores(pairs: DataFrame) -> DataFrame:
    """Add the seven components and ``sort_score``.

    Columns of the input name carry the prefix ``name_``, those of the record
    the prefix ``matched_``; the last four components but authorship depend on
    the record only and are there already.
    """
    c = F.col
    same_authors = (c("name_authors_text") != "") & (
        c("name_authors_text") == c("matched_authors_text")
    )
    authorship = (
        F.when(~has_authorship("name_"), F.when(has_authorship("matched_"), 2 / 7).otherwise(1 / 7))
        .when(same_authors & c("name_year").eqNullSafe(c("matched_year")), 1.0)
        .when(same_authors, 5 / 7)
        .when(c("name_year") == c("matched_year"), 3 / 7)
        .when(~has_authorship("matched_"), 1 / 7)
        .otherwise(0.0)
    )
    rank = (
        F.when(c("matched_cardinality") < 3, 0.0)
        .when((c("name_rank") == "") | (c("matched_rank") == ""), 0.5)
        .when(c("name_rank") == c("matched_rank"), 1.0)
        .otherwise(0.0)
    )
    scored = pairs.withColumns({
        "cardinality_score": F.when(c("name_cardinality") == c("matched_cardinality"), 1.0).otherwise(0.0),
        "rank_score": rank,
        "fuzzy_less_score": 1 - F.least(c("edit_distance"), F.lit(3)) / 3,
        "authorship_score": authorship,
    })
    return scored.withColumn("sort_score", sort_score(*COMPONENTS))


def sort_score(*components: str) -> Column:
    """Components as digits of one number, the deciding one first."""
    digits = [F.round(F.col(name) * STEPS).cast("long") for name in components]
    number = reduce(lambda total, digit: total * (STEPS + 1) + digit, digits)
    return number / float((STEPS + 1) ** len(components))


def score_bands(scored: DataFrame) -> DataFrame:
    """Each component as weak, medium or strong."""

    def band(name: str) -> Column:
        value = F.col(name)
        weak = value < (1.0 if name == "rank_score" else 0.3)
        strong = (value > 0.5) if name == "curation_score" else (value == 1)
        return F.when(weak, "weak").when(strong, "strong").otherwise("medium")

    bands = {name.replace("_score", "_band"): band(name) for name in COMPONENTS}
    return scored.withColumns(bands)


def match_labels(matches: DataFrame) -> DataFrame:
    """Add ``label``, the match type as a phrase."""
    kind = F.col("match_type")
    label = (
        F.when(kind == "Exact", F.concat(kind, F.lit(" match by canonical form")))
        .when(kind == "NoMatch", kind)
        .when(
            kind.isin("Fuzzy", "PartialFuzzy"),
            F.format_string("%s match, edit distance: %d", kind, F.col("edit_distance")),
        )
        .otherwise(F.concat(kind, F.lit(" match")))
    )
    return matches.withColumn("label", label)
