"""Names as columns: cleaning, canonical forms, stems, identifiers.

Everything here is a built-in column expression, so it runs inside the scan
stage of whatever table holds the names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Namespace of the name identifiers (UUID version 5).
NAME_NAMESPACE = "90181196fecf5082a4c1411d4f314cda"

# Rank marks of infraspecific epithets.
RANK_MARKS = ["subsp.", "ssp.", "var.", "f."]

# Lower-case words of authorships, which are never epithets.
CONNECTORS = [
    "and", "auct", "da", "de", "der", "du", "et", "ex", "in", "la",
    "nec", "non", "sensu", "van", "von",
]

# Epithet suffixes, longest first.
SUFFIXES = [
    "orum", "arum", "ibus", "ium", "ius", "us", "um", "is", "ae", "ei", "ii",
    "a", "e", "i", "o",
]

VIRUS = r"(?i)\b[a-z]*(virus|viruses|viroid|phage)\b"
CAPITAL = r"[A-Z][\p{Ll}-]+"  # a genus or subgenus
YEAR = r"\b((?:1[6-9]|20)[0-9]{2})\b"

_MARK = "(?:" + "|".join(m.replace(".", r"\.") for m in RANK_MARKS) + ")"
_WORD = "(?!(?:" + "|".join(CONNECTORS) + r")(?: |$))[\p{Ll}-]{2,}(?= |$)"
_HEAD = rf"^{CAPITAL}(?= |$)(?: (?:{_MARK} )?{_WORD})*"
_RANKED = rf"(?:^| ){_MARK} {_WORD}"
_STRAY = rf"(?:^| ){_WORD}"
# A hybrid sign before the genus, or before the epithet that follows genus and subgenus.
_HYBRID_GENUS = rf"^(?:× ?|x )(?={CAPITAL}(?: |$))"
_HYBRID = rf"^({CAPITAL}(?: \({CAPITAL}\))?) (?:× ?|x )(?={_WORD})"
# What stands in brackets after the genus is a subgenus if an epithet follows, else an author.
_SUBGENUS = rf"^({CAPITAL}) \(({CAPITAL})\) (?={_WORD})"
_BETWEEN_AUTHORS = r"[(),;&\[\]]| (?:ex|in|et|and) "
_YEAR_AFTER_BRACKET = r"\) ?,? ?(?:1[6-9]|20)[0-9]{2}"
_ENDING = r" ([\p{Ll}-]{3,}?)(?:" + "|".join(SUFFIXES) + ")(?= |$)"


def cleaned(name: Column) -> Column:
    """Name with outer whitespace dropped and inner runs collapsed, Unicode spaces too."""
    return F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s+", " "))


def capitalized(name: Column) -> Column:
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substr(name, F.lit(2)))


def stemmed(canonical: Column) -> Column:
    """Canonical form with the suffixes of its epithets removed."""
    return F.regexp_replace(canonical, _ENDING, " $1")


def name_id(name: Column) -> Column:
    """UUID version 5 of a name-string."""
    digest = F.sha1(F.concat(F.unhex(F.lit(NAME_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    # Empty only where the name is null, so joins on it need no null filter.
    return F.coalesce(
        F.concat(
            F.regexp_replace(F.substring(digest, 1, 16), "^(.{8})(.{4}).(.{3})$", "$1-$2-5$3-"),
            variant,
            F.regexp_replace(F.substring(digest, 18, 15), "^(.{3})(.{12})$", "$1-$2"),
        ),
        F.lit(""),
    )


def decomposed(df: DataFrame, name: str = "name") -> DataFrame:
    """Add the parts of a scientific name (rules D1-D7).

    A name-like string starts with a genus, which a subgenus in brackets may
    follow; signs of hybrids before genus or epithet are noted and left out.
    Its epithets are the lower-case words that follow, with or without a rank
    mark, and, inside an authorship, those right after a rank mark.
    ``match_key`` is the string under which a name meets records: the canonical
    form without ranks, or, where there is none, the lower-cased virus name or
    the string as it stands. A null or blank name has no parts. Patterns are
    tried only on strings that hold a text which each of their matches has.
    """
    c = F.col
    df = df.withColumn("clean", cleaned(c(name)))
    mixed = F.regexp_replace(F.regexp_replace("clean", _HYBRID_GENUS, ""), _HYBRID, "$1 ")
    signs = _holds("clean", "×", " x ") | c("clean").startswith("x ")
    df = df.withColumn("_lower", F.lower("clean")).withColumns({
        "is_virus": _holds("_lower", "virus", "viroid", "phage") & c("clean").rlike(VIRUS),
        "_unmixed": F.when(signs, mixed).otherwise(c("clean")),
    })
    bracket = _holds("_unmixed", " (")
    df = df.withColumns({
        "_subgenus": F.when(bracket, F.regexp_extract("_unmixed", _SUBGENUS, 2)).otherwise(""),
        "_plain": F.when(bracket, F.regexp_replace("_unmixed", _SUBGENUS, "$1 ")).otherwise(c("_unmixed")),
    })
    df = df.withColumn("_head", F.regexp_extract("_plain", _HEAD, 0))
    df = df.withColumns({
        "_named": (c("_head") != "") & ~c("is_virus"),
        "_tail": F.substr(c("_plain"), F.length("_head") + 1),
    })
    df = df.withColumns({
        "subgenus": F.when(c("_named") & (c("_subgenus") != ""), c("_subgenus")),
        "is_hybrid": c("_named") & (c("_unmixed") != c("clean")),
    })
    marked = _holds("_tail", ". ")
    ranked = F.when(marked, F.array_join(F.regexp_extract_all("_tail", F.lit(_RANKED), 0), "")).otherwise("")
    df = df.withColumns({
        "canonical_full": F.when(
            c("_named"), F.replace(F.concat("_head", ranked), F.lit(" ssp. "), F.lit(" subsp. "))
        ),
        "_authorship": F.trim(F.when(marked, F.regexp_replace("_tail", _RANKED, " &")).otherwise(c("_tail"))),
    })
    pointed, signed = _holds("canonical_full", "."), c("_named") & (c("_authorship") != "")
    df = df.withColumns({
        "canonical_simple": F.when(
            pointed, F.regexp_replace("canonical_full", r" (?:subsp|var|f)\.", "")
        ).otherwise(c("canonical_full")),
        "rank": F.when(
            pointed, F.regexp_extract("canonical_full", r"^.* (subsp\.|var\.|f\.) ", 1)
        ).otherwise(""),
        "authors_text": F.when(signed, _authors_text(c("_authorship"))).otherwise(""),
        "year": F.when(
            c("_named") & _holds("clean", "1", "2"), F.regexp_extract("clean", YEAR, 1).try_cast("int")
        ),
        "parse_quality": F.when(~c("_named"), 0)
        .when(~signed, 1)
        .when(c("_authorship").rlike(_STRAY), 3)
        .when(c("_authorship").rlike(_YEAR_AFTER_BRACKET), 2)
        .otherwise(1),
    })
    words = F.split("canonical_simple", " ")
    df = df.withColumns({
        "canonical_stem": stemmed(c("canonical_simple")),
        "cardinality": F.when(c("_named"), F.size(words)).otherwise(0),
        "genus": words[0],
        "epithets": F.when(c("_named"), F.slice(words, F.lit(2), F.size(words))),
        "authors": F.when(c("authors_text") != "", F.split("authors_text", r"\|")),
        "match_key": F.coalesce(
            F.when(c("_named"), c("canonical_simple"))
            .when(c("is_virus"), F.concat(F.lit("virus:"), F.lower("clean")))
            .otherwise(F.concat(F.lit("verbatim:"), c("clean"))),
            F.lit(""),
        ),
    })
    # Inputs that agree in all that matching and scoring look at.
    df = df.withColumn(
        "profile", F.concat_ws("|", "match_key", "rank", "authors_text", c("year").cast("string"))
    )
    return df.drop("_head", "_named", "_tail", "_authorship", "_unmixed", "_plain", "_subgenus", "_lower")


def _holds(column: str, *texts: str) -> Column:
    return reduce(Column.__or__, [F.contains(F.col(column), F.lit(t)) for t in texts])


def _authors_text(authorship: Column) -> Column:
    """Authors joined by a bar; stray words and years are no authors."""
    text = F.regexp_replace(F.regexp_replace(authorship, _STRAY, ""), "[0-9]+", "")
    text = F.regexp_replace(text, _BETWEEN_AUTHORS, "|")
    return F.btrim(F.regexp_replace(text, r"[| ]*\|[| ]*", "|"), F.lit("| "))
