"""What is known about matched records: accepted names, vernaculars, lineage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from taxaloom.functions.text import language_codes

VERNACULARS = "array<struct<name string, language string, language_code string>>"


def resolve_current(matches: DataFrame, prepared_records: DataFrame) -> DataFrame:
    """Add the accepted name of the record. ``shown_name`` is set where it differs."""
    current = prepared_records.select(
        "data_source_id",
        F.col("record_id").alias("current_record_id"),
        F.col("name").alias("current_name"),
        F.col("canonical_full").alias("current_canonical_full"),
        F.col("canonical_simple").alias("current_canonical_simple"),
        F.col("cardinality").alias("current_cardinality"),
    )
    status = (
        F.when(F.col("current_name").isNull(), "N/A")
        .when(F.col("is_synonym"), "Synonym")
        .otherwise("Accepted")
    )
    return matches.join(current, ["data_source_id", "current_record_id"], "left").withColumns({
        "taxonomic_status": status,
        "shown_name": F.when(
            F.col("current_name") != F.col("matched_name"), F.col("current_name")
        ),
    })


def _common_names(vernaculars: DataFrame, languages: str | Iterable[str]) -> DataFrame:
    """Vernaculars in the languages of a list or a comma-separated text of three-letter codes; ``all`` keeps every one."""
    text = languages if isinstance(languages, str) else ",".join(languages)
    wanted = language_codes(F.lit(text))
    chosen = F.array_contains(wanted, "all") | F.array_contains(wanted, F.col("language_code"))
    return vernaculars.filter(chosen).select(
        "data_source_id",
        F.col("record_id").alias("current_record_id"),
        F.col("name").alias("vernacular"),
        "language",
        "language_code",
    )


def attach_vernaculars(
    matches: DataFrame, vernaculars: DataFrame, languages: str | Iterable[str]
) -> DataFrame:
    """Common names of the matched records, one row each.

    Names hang on the accepted record, so synonyms find them too. Each matched
    record appears once, however many inputs it answers.
    """
    records = matches.select("data_source_id", "record_id", "current_record_id").distinct()
    return records.join(_common_names(vernaculars, languages), ["data_source_id", "current_record_id"])


def with_vernaculars(
    matches: DataFrame, vernaculars: DataFrame | None = None, languages: str | Iterable[str] | None = None
) -> DataFrame:
    """Every row of ``matches`` with the common names of its accepted record as an
    array, ordered by language and name; null where there are none.

    Only accepted records of matches are listed. A list is as long as the
    common names of one record.
    """
    if vernaculars is None or not languages:
        return matches.withColumn("vernaculars", F.lit(None).cast(VERNACULARS))
    key = ["data_source_id", "current_record_id"]
    wanted = matches.select(*key).distinct()
    one = F.struct(F.col("language_code"), F.col("vernacular"), F.col("language"))
    named = F.transform(
        F.array_sort(F.collect_set(one)),
        lambda v: F.struct(
            v["vernacular"].alias("name"), v["language"].alias("language"), v["language_code"].alias("language_code")
        ),
    )
    lists = _common_names(vernaculars, languages).join(wanted, key, "left_semi").groupBy(*key).agg(named.alias("vernaculars"))
    return matches.join(lists, key, "left")


def lineage(records: DataFrame) -> DataFrame:
    """Add the classification as an array and as text. Ranks count only where
    there is one for each taxon, and show only where they are not blank."""
    path = F.transform(F.split("classification_path", r"\|"), lambda t: F.trim(t))
    ranks = F.transform(F.split("classification_ranks", r"\|"), lambda t: F.trim(t))
    paired = F.when(
        F.size(path) == F.size(ranks),
        F.zip_with(path, ranks, lambda t, r: F.struct(t.alias("name"), r.alias("rank"))),
    ).otherwise(
        F.transform(path, lambda t: F.struct(t.alias("name"), F.lit("").alias("rank")))
    )
    shown = F.transform(
        "lineage",
        lambda t: F.when(
            t["rank"] != "", F.concat(t["name"], F.lit(" ("), t["rank"], F.lit(")"))
        ).otherwise(t["name"]),
    )
    known = F.coalesce("classification_path", F.lit("")) != ""
    return records.withColumn("lineage", F.when(known, paired)).withColumn(
        "lineage_text", F.when(known, F.array_join(shown, " >> ")).otherwise("")
    )


def sources_matched(matches: DataFrame, records: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """In how many sources each match key was found. ``held`` are the distinct
    forms and sources of an index, else those of found records are taken."""
    if held is None:
        found = matches.select("matched_key").distinct()
        held = records.select("matched_key", "data_source_id").join(found, "matched_key", "left_semi").distinct()
    return (
        matches.select("match_key", "matched_key")
        .join(held, "matched_key")
        .groupBy("match_key")
        .agg(F.countDistinct("data_source_id").alias("data_sources_num"))
    )


def source_stats(records: DataFrame, data_sources: DataFrame) -> DataFrame:
    """Sources with the number of their records."""
    counts = records.groupBy(F.col("data_source_id").alias("id")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    return data_sources.join(counts, "id", "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0).cast("long"))
    )


def lookup_sources(data_sources: DataFrame, ids: DataFrame) -> DataFrame:
    """The sources named by ``ids`` (column ``id``)."""
    return data_sources.join(ids.select("id").distinct(), "id", "left_semi")
