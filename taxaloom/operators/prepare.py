"""Lists of names and tables of records, made ready for matching."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.functions import names as fn
from taxaloom.functions.text import source_ids


def clean_names(names: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Trim all whitespace and drop blank names."""
    trimmed = names.withColumn("name", F.regexp_replace("name", r"(?U)^\s+|\s+$", ""))
    return trimmed if keep_blank else trimmed.filter(F.col("name") != "")


def is_blank(name: Column) -> Column:
    """Whether a name is null or white space only."""
    return ~F.coalesce(name, F.lit("")).rlike(r"(?U)\S")


def error_rows(names: DataFrame) -> DataFrame:
    """Names that cannot be verified, each with its error."""
    return names.filter(is_blank(F.col("name"))).select(
        "row_id",
        F.coalesce("name", F.lit("")).alias("name"),
        F.when(F.col("name").isNull(), "name is missing").otherwise("name is blank").alias("error"),
    )


def capitalize_names(names: DataFrame) -> DataFrame:
    """Add ``verified``: the name with its first character in upper case."""
    return names.withColumn("verified", fn.capitalized(F.col("name")))


def name_ids(names: DataFrame) -> DataFrame:
    return names.withColumn("id", F.when(F.col("name").isNotNull(), fn.name_id(F.col("name"))))


def decompose_names(names: DataFrame, column: str = "name") -> DataFrame:
    return fn.decomposed(names, column)


def stem_canonicals(df: DataFrame) -> DataFrame:
    return df.withColumn("canonical_stem", fn.stemmed(F.col("canonical_simple")))


def distinct_names(names: DataFrame) -> DataFrame:
    """Each name-string once, with the number of rows that hold it."""
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


def cap_names(
    names: DataFrame, limit: int | None = None, vernaculars: bool = False, relaxed: bool = False
) -> DataFrame:
    """The first names of the input, counted before blanks are dropped: ``limit``,
    else 5000, or 50 where common names or relaxed matching are asked for."""
    if limit is None:
        limit = 50 if vernaculars or relaxed else 5000
    return names.orderBy("row_id").limit(limit)


def filter_sources(records: DataFrame, ids: Iterable[int] | str | None) -> DataFrame:
    """Records of the chosen sources. ``[0]`` or nothing keeps all; negatives are void.

    Ids may be a comma-separated text, in which a bad item voids the list.
    """
    if isinstance(ids, str):
        wanted = F.coalesce(source_ids(F.lit(ids), strict=True), F.array().cast("array<int>"))
        everything = (F.size(wanted) == 0) | (wanted == F.array(F.lit(0)))
        return records.filter(everything | F.array_contains(wanted, F.col("data_source_id").cast("int")))
    wanted = sorted({i for i in ids or [] if i >= 0})
    if not wanted or wanted == [0]:
        return records
    return records.filter(F.col("data_source_id").isin(wanted))


def prepared_names(names: DataFrame, capitalize: bool = False) -> DataFrame:
    """Clean, decomposed names; ``name`` stays as it came in."""
    kept = names.filter(~is_blank(F.col("name")))
    if not capitalize:
        return fn.decomposed(kept)
    return fn.decomposed(capitalize_names(kept), "verified").drop("verified")


#: What matching, ranking and results take of the names.
NAME_COLUMNS = ["row_id", "name", "profile", "match_key", "cardinality", "rank", "authors_text", "year"]


def prepared_records(records: DataFrame) -> DataFrame:
    """Decomposed records with the identifiers of their name-strings."""
    return fn.decomposed(records).withColumn("name_id", fn.name_id(F.col("name")))


def name_keys(names: DataFrame) -> DataFrame:
    """Distinct match keys of the input. Matching sees each only once."""
    keys = names.select("match_key", "cardinality").distinct()
    words = F.split("match_key", " ")
    return keys.withColumns({
        "genus": F.when(F.col("cardinality") > 0, words[0]),
        "epithets": F.when(F.col("cardinality") > 1, F.slice(words, F.lit(2), F.size(words))),
    })


def record_keys(prepared: DataFrame) -> DataFrame:
    """Distinct match keys of the records, in the columns ``matched_*``."""
    return prepared.select(
        F.col("match_key").alias("matched_key"),
        F.col("canonical_stem").alias("matched_stem"),
        F.col("cardinality").alias("matched_cardinality"),
    ).distinct()
