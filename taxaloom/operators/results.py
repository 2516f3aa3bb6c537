"""Documents per input name and flat rows made from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.functions.names import name_id
from taxaloom.operators.ranking import TIES
from taxaloom.session import cut

# Columns of flat rows.
FLAT_COLUMNS = [
    "Kind", "SortScore", "MatchType", "EditDistance", "ScientificName", "MatchedName",
    "MatchedCanonical", "TaxonId", "CurrentName", "TaxonomicStatus", "DataSourceId",
    "DataSourceTitle", "ClassificationPath", "Error",
]

# Columns of scored records that flat rows do not show.
NOT_IN_FLAT = [
    "matched_canonical_simple", "curation", "classification_ranks", "outlink", "local_id", "entry_date",
    "classification_ids",
]

# Columns of scored matches that no flat row shows, once their score is known.
ONLY_FOR_SCORES = [
    "match_key", "name_cardinality", "name_rank", "name_authors_text", "name_year", "matched_key",
    "matched_cardinality", "matched_rank", "matched_authors_text", "matched_year", "stem_edit_distance",
    "cardinality_score", "rank_score", "fuzzy_less_score", "curation_score", "authorship_score",
    "acceptance_score", "parse_quality_score",
]

RESULT_FIELDS = [
    "data_source_id", "data_source_title", "curation", "record_id", "local_id", "outlink", "entry_date",
    "matched_name", "matched_cardinality", "matched_canonical_simple", "matched_canonical_full",
    "current_record_id", "current_name", "current_cardinality", "current_canonical_simple",
    "current_canonical_full", "taxonomic_status", "is_synonym", "classification_path",
    "classification_ranks", "classification_ids", "edit_distance", "stem_edit_distance",
    "match_type", "sort_score", "vernaculars",
]
SCORE_FIELDS = [
    "cardinality_score", "rank_score", "fuzzy_less_score", "curation_score",
    "authorship_score", "acceptance_score", "parse_quality_score",
]


def result_struct() -> Column:
    return F.struct(*RESULT_FIELDS, F.struct(*SCORE_FIELDS).alias("score_details"))


def in_order() -> Column:
    """Results of a group in the order of the ranking."""
    keyed = F.struct((-F.col("sort_score")).alias("_key"), *TIES, result_struct().alias("_result"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda r: r["_result"])


def profile_documents(
    best: DataFrame, results: DataFrame | None = None, sources: DataFrame | None = None,
    tied: DataFrame | None = None,
) -> DataFrame:
    """One document per profile. ``results`` and ``tied`` hold records as rows;
    a document's lists are as long as what it has to show."""
    documents = best.select(
        "profile", "match_key", "match_type", "curation", result_struct().alias("best_result")
    )
    for rows, name in ((results, "results"), (tied, "best_results")):
        if rows is not None:
            lists = rows.groupBy("profile").agg(in_order().alias(name))
            documents = documents.join(lists, "profile", "left")
        else:
            documents = documents.withColumn(name, F.slice(F.array("best_result"), 1, 0))
    if sources is not None:
        documents = documents.join(sources, "match_key", "left")
    else:
        documents = documents.withColumn("data_sources_num", F.lit(None).cast("long"))
    return documents.drop("match_key")


def nest_results(
    names: DataFrame, best: DataFrame, results: DataFrame | None = None,
    sources: DataFrame | None = None, tied: DataFrame | None = None,
) -> DataFrame:
    """One document per input row.

    Documents are put together per profile, stored, and joined to the rows
    once. Against a stored table the rows of a hot profile can be split.
    """
    documents = cut(profile_documents(best, results, sources, tied))
    rows = names.select("row_id", name_id(F.col("name")).alias("id"), "name", "profile")
    return rows.join(documents, "profile", "left").select(
        "row_id",
        "id",
        "name",
        F.coalesce("match_type", F.lit("NoMatch")).alias("match_type"),
        "best_result",
        "best_results",
        "results",
        F.coalesce("data_sources_num", F.lit(0).cast("long")).alias("data_sources_num"),
        F.coalesce("curation", F.lit("NotCurated")).alias("curation"),
        F.lit(None).cast("string").alias("error"),
    )


def best_curation(names: DataFrame, best: DataFrame) -> DataFrame:
    """Curation of the best result; names without a match are not curated."""
    found = cut(best.select("profile", "curation"))
    return names.select("row_id", "profile").join(found, "profile", "left").select(
        "row_id", F.coalesce("curation", F.lit("NotCurated")).alias("curation")
    )


def with_errors(documents: DataFrame, errors: DataFrame) -> DataFrame:
    """Documents and, for names that could not be verified, their errors."""
    failed = errors.select(
        "row_id",
        name_id(F.col("name")).alias("id"),
        "name",
        F.lit("NoMatch").alias("match_type"),
        F.lit("NotCurated").alias("curation"),
        "error",
    )
    return documents.unionByName(failed, allowMissingColumns=True)


def _flat(result: Callable[[str], Column], kind: Column, found: Column) -> list[Column]:
    """The columns of a flat row but for those of the input; empty where nothing was ``found``."""

    def text(field: str) -> Column:
        return F.coalesce(result(field).cast("string"), F.lit(""))

    return [
        kind.alias("Kind"),
        F.when(found, F.format_string("%.5f", result("sort_score"))).otherwise("0.0").alias("SortScore"),
        F.when(found, result("match_type")).otherwise("NoMatch").alias("MatchType"),
        text("edit_distance").alias("EditDistance"),
        text("matched_name").alias("MatchedName"),
        text("matched_canonical_full").alias("MatchedCanonical"),
        text("record_id").alias("TaxonId"),
        text("current_name").alias("CurrentName"),
        text("taxonomic_status").alias("TaxonomicStatus"),
        text("data_source_id").alias("DataSourceId"),
        text("data_source_title").alias("DataSourceTitle"),
        text("classification_path").alias("ClassificationPath"),
    ]


def _kind(position: Column) -> Column:
    """The best row and the first of the results are best matches both."""
    return F.when(position <= 1, "BestMatch").otherwise("SortedMatch")


def flat_rows(documents: DataFrame) -> DataFrame:
    """The 14 text columns, best row first, then the results.

    The first element of the results is a best match too; a document without
    both gives one empty row.
    """
    none = F.slice(F.array("best_result"), 1, 0)
    best = F.when(F.col("best_result").isNotNull(), F.array("best_result")).otherwise(none)
    both = F.concat(best, F.coalesce("results", none))
    rows = documents.select(
        "row_id", "name", "error", F.when(F.col("best_result").isNull(), 1).otherwise(0).alias("place"),
        F.posexplode_outer(both).alias("position", "r"),
    ).withColumn("place", F.col("place") + F.col("position"))
    found = F.col("r").isNotNull()
    kind = F.when(found, _kind(F.col("place"))).otherwise("SortedMatch")
    return rows.select(
        "row_id", F.coalesce("position", F.lit(0)).alias("position"), "name", "error",
        *_flat(lambda c: F.col("r")[c], kind, found),
    ).select("row_id", "position", *_named_columns())


def _named_columns() -> list[Column]:
    given = {"ScientificName": F.col("name"), "Error": F.coalesce("error", F.lit(""))}
    return [given[c].alias(c) if c in given else F.col(c) for c in FLAT_COLUMNS]


def flat_matches(names: DataFrame, errors: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows of :func:`flat_rows` without documents between, from results as rows.

    ``placed`` has the best result of a profile at ``position`` 0 and those
    listed after it from 1 on. They are formatted once per profile and stored,
    and no list of a profile is put together, so it may have any number of them.
    """
    position = F.col("position")
    formatted = cut(placed.select("profile", "position", *_flat(F.col, _kind(position), F.lit(True))))
    rows = names.select("row_id", "name", "profile").join(formatted, "profile", "left").drop("profile")
    rows = rows.withColumn("error", F.lit(None).cast("string")).unionByName(
        errors.select("row_id", "name", "error"), allowMissingColumns=True
    )
    empty = {"Kind": "SortedMatch", "SortScore": "0.0", "MatchType": "NoMatch"}
    return rows.select(
        "row_id", F.coalesce("position", F.lit(0)).alias("position"), "name", "error",
        *[F.coalesce(c, F.lit(empty.get(c, ""))).alias(c) for c in FLAT_COLUMNS if c not in ("ScientificName", "Error")],
    ).select("row_id", "position", *_named_columns())


def keep_input_order(rows: DataFrame) -> DataFrame:
    order = [c for c in ("row_id", "position") if c in rows.columns]
    return rows.orderBy(*order)


def order_by_name(documents: DataFrame) -> DataFrame:
    """Rows by name; those of equal names by their place in the input or by search,
    so that a name of very many rows is no single range."""
    order = [c for c in ("row_id", "query_id", "position", "record_id") if c in documents.columns]
    return documents.orderBy("name", *order)


def batch_metadata(
    names: DataFrame, sources: list[int] | None = None, **options: bool
) -> DataFrame:
    """Number of input rows, errors included, with the options of the run."""
    echoed = [F.lit(value).alias(name) for name, value in options.items()]
    chosen = F.array(*[F.lit(i) for i in sources or []]).cast("array<int>")
    return names.agg(F.count(F.lit(1)).alias("names_number")).select(
        "names_number", chosen.alias("data_sources"), *echoed
    )
