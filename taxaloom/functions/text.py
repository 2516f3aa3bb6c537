"""Option texts as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def source_ids(text: Column, strict: bool = False) -> Column:
    """Source numbers of a comma-separated text. Negatives are dropped; a bad
    item is skipped or, with ``strict``, voids the list."""
    items = F.transform(F.split(text, ","), lambda s: F.trim(s).try_cast("int"))
    kept = F.filter(items, lambda i: i >= 0)
    if not strict:
        return kept
    return F.when(~F.exists(items, lambda i: i.isNull()), kept)


def language_codes(text: Column) -> Column:
    """Three-letter language codes of a comma-separated text."""
    items = F.transform(F.split(text, ","), lambda s: F.trim(s))
    return F.filter(items, lambda s: F.length(s) == 3)
