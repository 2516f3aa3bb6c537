"""Lookup of name-strings by text or identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.functions.names import name_id
from taxaloom.operators.prepare import filter_sources
from taxaloom.operators.ranking import TIES, first_of

_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def lookup_name_strings(
    ids: DataFrame,
    records: DataFrame,
    sources: list[int] | None = None,
    all_matches: bool = False,
) -> DataFrame:
    """Records of the name-strings in ``ids (id)``, one per source or all.

    An identifier is taken as it is, anything else as the name itself, percent
    escapes undone.
    """
    text = F.coalesce(F.try_url_decode("id"), F.col("id"))
    inputs = ids.select(F.col("id").alias("input"), text.alias("text")).distinct()
    given = F.when(F.lower("text").rlike(_UUID), F.lower("text"))
    wanted = inputs.select(
        "input", F.coalesce(given, name_id(F.col("text")), F.lit("")).alias("name_id")
    )
    # Prepared records hold the identifier already.
    identifier = F.col("name_id") if "name_id" in records.columns else name_id(F.col("name"))
    held = filter_sources(records, sources).select(
        identifier.alias("name_id"),
        F.col("name").alias("matched_name"),
        "data_source_id", "record_id", "current_record_id", "is_synonym", "classification_path",
    )
    # Only records of wanted names are ordered.
    held = held.join(wanted.select("name_id").distinct(), "name_id", "left_semi")
    if not all_matches:
        held = first_of(held, ["name_id", "data_source_id"], [F.asc(c) for c in TIES])
    return wanted.join(held, "name_id")
