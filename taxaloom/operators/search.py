"""Faceted search: a table of searches against the records, as one job.

Facets are words, whole or abbreviated. Distinct facet words meet distinct
record words in an equi-join: a record word is listed under its stem and under
each of its beginnings, so it meets at most as many facet words as it has
letters. Searches then meet canonical forms on the pair of their genus and
epithet facets, and records grouped by what the other facets look at.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.functions.names import RANK_MARKS, cleaned, name_id, stemmed
from taxaloom.functions.scores import with_scores
from taxaloom.functions.text import source_ids
from taxaloom.operators.attach import resolve_current, with_vernaculars
from taxaloom.operators.order import placed
from taxaloom.operators.pairs import fan_out
from taxaloom.operators.results import in_order, result_struct
from taxaloom.session import cut

# Keys of the query language.
KEYS = ["g", "sp", "isp", "asp", "au", "y", "ds", "tx", "all", "n"]

FACETS = [
    "genus", "species", "infraspecies", "any_epithet", "author",
    "year_from", "year_to", "sources", "taxon",
]
MAIN_SOURCE = 1  # its classification answers tx: where no source is given
ANY = "*"
RECORD = ["data_source_id", "record_id"]  # what names a record
YEAR_LEVELS = 32   # sizes of blocks of years, from one up by powers of two
STRIP = 64         # places of a strip of the classification's order

_NEXT = rf"(?=\s+(?:{'|'.join(KEYS)}):|\s*$)"
_MARKS = "|".join(m.replace(".", r"\.") for m in RANK_MARKS)
_N_WORDS = rf"^[A-Z][\p{{Ll}}-]*\.?((?: (?:{_MARKS}|[\p{{Ll}}-]{{2,}}\.?)(?= |$))*)"
_YEARS = r"(?:^| )(-[0-9]{4}|[0-9]{4}-?(?:[0-9]{4})?)(?= |$)"


def _value(key: str) -> Column:
    found = F.trim(F.regexp_extract("_query", rf"(?:^|\s){key}:(.*?){_NEXT}", 1))
    return F.when(found != "", found)


def extract_facets(searches: DataFrame) -> DataFrame:
    """Facets of each ``query`` as columns. Parts of ``n:`` fill what is not given; a list of
    sources without a number counts as not given, bad and negative items are skipped."""
    df = searches.withColumn("_query", cleaned(F.col("query")))
    df = df.withColumn("name_text", _value("n"))
    words = F.regexp_extract("name_text", _N_WORDS, 1)
    df = df.withColumns({
        "_words": F.split(
            F.trim(F.regexp_replace(words, rf"(?:^| )(?:{_MARKS})(?= |$)", "")), " "
        ),
        "_genus": F.regexp_extract("name_text", r"^([A-Z][\p{Ll}-]*\.?)(?: |$)", 1),
        "_tail": F.regexp_replace("name_text", _N_WORDS, ""),
    })
    author = F.btrim(F.regexp_replace("_tail", _YEARS, ""), F.lit(" (),"))

    def present(text: Column) -> Column:
        return F.when(text != "", text)

    df = df.withColumns({
        "genus": F.coalesce(_value("g"), present(F.col("_genus"))),
        "species": F.coalesce(_value("sp"), present(F.get("_words", 0))),
        "infraspecies": F.coalesce(_value("isp"), present(F.get("_words", 1))),
        "any_epithet": _value("asp"),
        "author": F.coalesce(_value("au"), present(author)),
        "_year": F.coalesce(_value("y"), present(F.regexp_extract("_tail", _YEARS, 1))),
        "taxon": _value("tx"),
        "all_results": F.coalesce(_value("all").startswith("t"), F.lit(False)),
        "_ds": source_ids(_value("ds")),
    }).withColumn("sources", F.when(F.size("_ds") > 0, F.col("_ds")))
    since = F.regexp_extract("_year", "^([0-9]{4})", 1)
    until = F.regexp_extract("_year", "([0-9]{4})$", 1)
    return df.withColumns({
        "year_from": present(since).cast("int"),
        "year_to": present(until).cast("int"),
    }).select("query_id", "query", "name_text", *FACETS, "all_results")


def facet_sources(facets: DataFrame, sources: list[int] | None) -> DataFrame:
    """The caller's sources take the place of those in the query; ``[0]`` asks for all results of all."""
    if not sources:
        return facets
    if 0 in sources:
        return facet_all(facets.withColumn("sources", F.lit(None).cast("array<int>")), True)
    return facets.withColumn("sources", F.array(*[F.lit(i) for i in sources]))


def facet_all(facets: DataFrame, all_matches: bool = False) -> DataFrame:
    """The caller's flag makes every search return all results."""
    return facets.withColumn("all_results", F.col("all_results") | F.lit(all_matches))


def valid_searches(facets: DataFrame) -> DataFrame:
    """Add ``error`` where no epithet is given."""
    epithet = F.coalesce("species", "infraspecies", "any_epithet")
    return facets.withColumn(
        "error", F.when(epithet.isNull(), "the search needs sp:, isp: or asp:")
    )


def _abbreviated(facet: Column) -> Column:
    return facet.endswith(".") | (F.length(facet) == 1)


def _facet_key(facet: Column, whole: Column) -> Column:
    beginning = F.concat(F.lit("beginning "), F.rtrim(facet, F.lit(".")))
    return F.when(_abbreviated(facet), beginning).otherwise(F.concat(F.lit("word "), whole))


def facet_words(
    facets: DataFrame, words: DataFrame, gender: bool = False
) -> DataFrame:
    """Pairs ``(facet, word)`` of distinct facet words and distinct words.

    A facet with a point, or of one letter, stands for all words that begin so.
    With ``gender``, whole words agree in the stem, as in any gender.
    """

    def stem(word: Column) -> Column:
        # The ending rule applies to epithets, which follow a space.
        return F.substr(stemmed(F.concat(F.lit(" "), word)), F.lit(2)) if gender else word

    facet, word = F.col("facet"), F.col("word")
    beginnings = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda n: F.concat(F.lit("beginning "), F.substr(word, F.lit(1), n)),
    )
    listed = words.filter(word != "").withColumn(
        "_key", F.explode(F.concat(F.array(F.concat(F.lit("word "), stem(word))), beginnings))
    )
    wanted = facets.withColumn("_key", _facet_key(facet, stem(facet)))
    return wanted.join(listed, "_key").select("facet", "word")


def _wanted(facets: DataFrame, *columns: str) -> DataFrame:
    """Distinct words of some facets, in the column ``facet``."""
    values = F.array_compact(F.array(*columns))
    return facets.select(F.explode(values).alias("facet")).distinct()


def _with_words(facets: DataFrame, facet: str, words: DataFrame, gender: bool = False) -> DataFrame:
    """(query_id, data_source_id, record_id): records that a facet finds by one of their ``words``.

    Distinct facet words meet distinct record words; then records are listed
    once per facet word, however many of their words it finds and however many
    searches ask for it, and stored, so that the searches of a frequent one and
    its records can be split among tasks.
    """
    pairs = facet_words(_wanted(facets, facet), words.select("word").distinct(), gender)
    hits = cut(words.join(pairs, "word").select("facet", *RECORD).distinct())
    asked = facets.filter(F.col(facet).isNotNull()).select("query_id", F.col(facet).alias("facet"))
    return fan_out(asked, hits, "facet").select("query_id", *RECORD)


def _words(records: DataFrame, words: Column) -> DataFrame:
    """Records with each of an array's words."""
    return records.select(*RECORD, F.explode(words).alias("word"))


def _later_epithets() -> Column:
    return F.slice("epithets", F.lit(2), F.size("epithets"))


def facet_genus(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records of the genus of each search."""
    return _with_words(facets, "genus", _words(records, F.array_compact(F.array("genus"))))


def facet_species(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose first epithet is that of the search, in any gender."""
    return _with_words(facets, "species", _words(records, F.slice("epithets", 1, 1)), gender=True)


def facet_infraspecies(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records with the epithet of the search after their first, in any gender."""
    return _with_words(facets, "infraspecies", _words(records, _later_epithets()), gender=True)


def facet_any_epithet(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records with the epithet of the search anywhere, in any gender."""
    return _with_words(facets, "any_epithet", _words(records, F.col("epithets")), gender=True)


def facet_gender(facets: DataFrame, records: DataFrame) -> DataFrame:
    """(query_id, facet, word, data_source_id, record_id): records that a whole epithet
    of a search finds by an epithet of another gender, wherever each stands.

    Where a facet looks and where a word stands are sets of places, 1 the first
    epithet, 2 the later ones, 3 both. Each side has one row for a set, so what
    they give together is distinct without a comparison of all found rows.
    """
    looks = {"species": 1, "infraspecies": 2, "any_epithet": 3}
    asked = facets.select("query_id", F.inline(F.array(*[
        F.struct(F.col(facet).alias("facet"), F.lit(places).alias("looks")) for facet, places in looks.items()
    ]))).filter(F.col("facet").isNotNull() & ~_abbreviated(F.col("facet")))
    asked = asked.groupBy("query_id", "facet").agg(F.bit_or("looks").alias("looks"))
    both = cut(asked.select(
        "query_id", "facet", F.explode(F.filter(F.array(*[F.lit(n) for n in (1, 2, 3)]), lambda n: n.bitwiseAND(F.col("looks")) > 0)).alias("places")
    ))
    words = records.select(*RECORD, F.posexplode("epithets").alias("place", "word")).groupBy(*RECORD, "word").agg(
        F.bit_or(F.when(F.col("place") == 0, 1).otherwise(2)).alias("places")
    )
    pairs = facet_words(both.select("facet").distinct(), words.select("word").distinct(), gender=True)
    hits = cut(words.join(pairs.filter("facet <> word"), "word"))
    return fan_out(both, hits, "facet", "places").select("query_id", "facet", "word", *RECORD)


def facet_author(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records with the author of each search among theirs."""
    return _with_words(facets, "author", _words(records, F.col("authors")))


def _in_years(year: Column) -> Column:
    since, until = F.col("year_from"), F.col("year_to")
    return (since.isNull() | (year >= since)) & (until.isNull() | (year <= until))


def _blocks(first: Column, last: Column) -> Column:
    """The fewest aligned blocks of 1, 2, 4 ... numbers that make up a range, two of a size at most."""

    def of_size(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level).cast("long")
        low, high = F.ceil(first / size), F.floor((last + 1) / size) - 1
        at = lambda n: F.struct(level.alias("level"), n.cast("long").alias("block"))
        return F.array_compact(F.array(
            F.when((low <= high) & (low % 2 == 1), at(low)), F.when((low <= high) & (high % 2 == 0), at(high))
        ))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(YEAR_LEVELS - 1)), of_size))


def facet_year(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records with a year in the range of each search; both ends count, either may be open.

    A range is cut into aligned blocks of years, a year is in one block of each
    size, and both meet in an equi-join: each year of a range exactly once.
    """
    years = records.select("year").filter("year >= 0").distinct()
    dated = facets.filter(F.coalesce("year_from", "year_to").isNotNull())
    ranges = dated.select("year_from", "year_to").distinct()
    blocks = ranges.withColumn("at", F.explode(_blocks(
        F.greatest(F.coalesce("year_from", F.lit(0)), F.lit(0)).cast("long"),
        F.coalesce("year_to", F.lit((1 << YEAR_LEVELS - 1) - 1)).cast("long"),
    ))).select("year_from", "year_to", "at.level", "at.block")
    leveled = years.select("year", F.explode(F.sequence(F.lit(0), F.lit(YEAR_LEVELS - 1))).alias("level"))
    in_blocks = leveled.withColumn("block", F.floor(F.col("year") / F.pow(F.lit(2.0), F.col("level"))).cast("long"))
    pairs = blocks.join(in_blocks, ["level", "block"]).select("year_from", "year_to", "year")
    # A year is listed once for the searches of it, not once for each range.
    years_of = F.to_json(F.struct("year_from", "year_to")).alias("years")
    asked = cut(dated.select("query_id", years_of).join(pairs.select(years_of, "year"), "years").select("query_id", "year"))
    return fan_out(asked, cut(records.select(*RECORD, "year")), "year").select("query_id", *RECORD)


def records_of_sources(facets: DataFrame, records: DataFrame) -> DataFrame:
    """Records of the sources that each search names."""
    asked = facets.select("query_id", F.explode(F.array_distinct("sources")).alias("data_source_id"))
    return fan_out(cut(asked), cut(records.select(*RECORD)), "data_source_id").select("query_id", *RECORD)


class TaxonTree(NamedTuple):
    """Classifications of all sources as intervals: in the order of their paths,
    what lies below a taxon is a range."""

    forms: DataFrame  # data_source_id, match_key, place: where a form's path stands
    taxa: DataFrame   # data_source_id, taxon, first, last: places of the paths below a taxon


def taxon_tree(records: DataFrame) -> TaxonTree:
    """Number the distinct paths of each source and note the range below each of their taxa.

    Paths are ordered taxon by taxon, so all that begin alike stand together. A
    taxon of one name at several places of a tree has several ranges.
    """
    parts = F.split("classification_path", r"\|")
    # The least of all characters parts the taxa of a path, else "Ab" comes between "A" and "A|B".
    path = F.array_join(parts, "\u0001").alias("path")
    classified = records.filter("classification_path <> ''").select("data_source_id", "match_key", path)
    paths = cut(placed(classified.select("data_source_id", "path").distinct(), [F.asc("data_source_id"), F.asc("path")]))
    taxa = F.split("path", "\u0001")
    each = paths.select("data_source_id", "place", taxa.alias("taxa"), F.posexplode(taxa).alias("depth", "taxon"))
    ranges = each.groupBy("data_source_id", F.slice("taxa", F.lit(1), F.col("depth") + 1).alias("node"), "taxon").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    forms = classified.join(paths, ["data_source_id", "path"]).select("data_source_id", "match_key", "place").distinct()
    return TaxonTree(cut(forms), cut(ranges.drop("node")))


def _classifying_source() -> Column:
    return F.coalesce(F.try_element_at("sources", F.lit(1)), F.lit(MAIN_SOURCE))


def _below(asked: DataFrame, tree: TaxonTree) -> DataFrame:
    """(taxon, by_source, match_key): forms below the taxa that are ``asked`` for, each once.

    A range is spelled out in strips of places, of which a form is in one; so
    it gives few more rows than a ``STRIP``-th of the paths below it.
    """
    strip = lambda c: F.floor(F.col(c) / STRIP)
    ranges = (
        asked.select("taxon", "by_source").distinct()
        .join(tree.taxa.withColumnRenamed("data_source_id", "by_source"), ["taxon", "by_source"])
        .withColumn("strip", F.explode(F.sequence(strip("first"), strip("last"))))
    )
    forms = tree.forms.withColumnRenamed("data_source_id", "by_source").withColumn("strip", strip("place"))
    return (
        ranges.join(forms, ["by_source", "strip"]).filter("place >= first AND place <= last")
        .select("taxon", "by_source", "match_key").distinct()
    )


def facet_taxon(facets: DataFrame, records: DataFrame, tree: TaxonTree | None = None) -> DataFrame:
    """Records of the forms below the taxon of each search, by the classification
    of the first source of the search or else of the main source."""
    asked = facets.filter(F.col("taxon").isNotNull()).select("query_id", "taxon", _classifying_source().alias("by_source"))
    below = _below(asked, tree or taxon_tree(records))
    hits = cut(below.join(records.select("match_key", *RECORD), "match_key").drop("match_key"))
    return fan_out(asked, hits, "taxon", "by_source").select("query_id", *RECORD)


def _forms_found(
    searches: DataFrame, records: DataFrame, tree: TaxonTree | None = None
) -> tuple[DataFrame, DataFrame]:
    """The searches with their ``signature``, and the forms of each signature.

    A signature is what a search asks of canonical forms: genus, epithets and
    taxon. Forms are found once for each, stored, and meet the searches last,
    whatever authors, years and sources these ask for.
    """
    forms = (
        records.filter(F.col("cardinality") > 1)
        .select("match_key", "genus", "epithets")
        .distinct()
    )
    role = (
        F.when(F.col("species").isNotNull(), "species")
        .when(F.col("infraspecies").isNotNull(), "infraspecies")
        .otherwise("any")
    )
    asked_of_forms = [
        "role", "epithet_facet", "genus_facet", "infraspecies", "any_epithet", "taxon", "by_source",
    ]
    signed = searches.withColumns({
        "role": role,
        "epithet_facet": F.coalesce("species", "infraspecies", "any_epithet"),
        "genus_facet": F.coalesce("genus", F.lit(ANY)),
        "by_source": F.when(F.col("taxon").isNotNull(), _classifying_source()),
    }).withColumn("signature", F.to_json(F.struct(*asked_of_forms)))
    asked = cut(signed.select("signature", *asked_of_forms).distinct())
    epithets = facet_words(
        asked.select(F.col("epithet_facet").alias("facet")).distinct(),
        forms.select(F.explode("epithets").alias("word")).distinct(),
        gender=True,
    )
    genera = facet_words(
        asked.select(F.col("genus_facet").alias("facet")).filter(F.col("facet") != ANY).distinct(),
        forms.select(F.col("genus").alias("word")).distinct(),
    )
    roles = F.when(F.col("place") == 0, F.array(F.lit("species"), F.lit("any"))).otherwise(
        F.array(F.lit("infraspecies"), F.lit("any"))
    )
    by_epithet = (
        forms.select("match_key", F.col("genus"), F.posexplode("epithets").alias("place", "word"))
        .join(epithets, "word")
        .select("match_key", "genus", F.col("facet").alias("epithet_facet"), F.explode(roles).alias("role"))
        .distinct()
    )
    named = by_epithet.join(
        genera.select(F.col("word").alias("genus"), F.col("facet").alias("genus_facet")), "genus"
    )
    listed = named.select("match_key", "role", "epithet_facet", "genus_facet").unionByName(
        by_epithet.select("match_key", "role", "epithet_facet", F.lit(ANY).alias("genus_facet"))
    )
    words = F.split("match_key", " ")
    later, every = F.slice(words, F.lit(3), F.size(words)), F.slice(words, F.lit(2), F.size(words))
    found = asked.join(listed, ["role", "epithet_facet", "genus_facet"]).filter(
        _some_word("infraspecies", later) & _some_word("any_epithet", every)
    ).select("signature", "match_key", "taxon", "by_source")
    if asked.filter("taxon IS NOT NULL").isEmpty():
        return signed.drop(*asked_of_forms[:3], "by_source"), cut(found.select("signature", "match_key"))
    found = cut(found)
    below = found.filter("taxon IS NOT NULL")
    below = below.join(
        _below(asked.filter("taxon IS NOT NULL"), tree or taxon_tree(records)),
        ["taxon", "by_source", "match_key"], "left_semi",
    )
    forms_of = found.filter("taxon IS NULL").unionByName(below).select("signature", "match_key")
    return signed.drop(*asked_of_forms[:3], "by_source"), cut(forms_of)


def _some_word(facet: str, words: Column) -> Column:
    """The facet is absent or agrees with one of the words."""
    asked = F.col(facet)

    def stem(word: Column) -> Column:
        return stemmed(F.concat(F.lit(" "), word))

    def agrees(word: Column) -> Column:
        return F.when(
            _abbreviated(asked), word.startswith(F.rtrim(asked, F.lit(".")))
        ).otherwise(stem(word) == stem(asked))

    return asked.isNull() | F.exists(words, agrees)


def _ranked_records(records: DataFrame) -> DataFrame:
    """Records scored as answers to a search, which names no rank or author."""
    asked = records.withColumns({
        "name_cardinality": F.col("matched_cardinality"),
        "name_rank": F.lit(""),
        "name_authors_text": F.lit(""),
        "name_year": F.lit(None).cast("int"),
        "edit_distance": F.lit(0),
    })
    return with_scores(asked)


def _of_forms(scored: DataFrame, found: DataFrame) -> DataFrame:
    forms = found.select(F.col("match_key").alias("matched_key"))
    return scored.join(forms, "matched_key", "left_semi")


def _listed(searches: DataFrame, classes: DataFrame) -> DataFrame:
    """Record classes under each author facet and source facet they answer."""
    by_author = classes.withColumn("word", F.explode(F.split("authors_text", r"\|")))
    author_words = facet_words(_wanted(searches, "author"), by_author.select("word").distinct())
    signed = (
        by_author.join(author_words, "word")
        .withColumnRenamed("facet", "author_facet")
        .drop("word")
        .distinct()
    )
    return signed.unionByName(classes.withColumn("author_facet", F.lit(ANY))).withColumn(
        "source_facet", F.explode(F.array(F.lit(ANY), F.col("source").cast("string")))
    )


def _record_groups(searches: DataFrame, ranked: DataFrame) -> DataFrame:
    """Records by what facets look at: form, author facet, source, year.

    Each group keeps its first record and its size. There are at most as many
    groups per form and facet as there are years, so searches meet a bounded
    number of groups, however many records a form has.
    """
    first = F.struct(
        (-F.col("sort_score")).alias("order"), "matched_name", "data_source_id", "record_id",
        "sort_score", "matched_cardinality",
    )
    classes = ranked.groupBy(*_class_columns()).agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("n_records")
    )
    listed = (
        _listed(searches, classes)
        .withColumn("dated", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("year", F.when(F.col("dated"), F.col("year")))
    )
    return listed.groupBy("match_key", "author_facet", "source_facet", "dated", "year").agg(
        F.min("first").alias("first"), F.sum("n_records").alias("n_records")
    )


def _class_columns() -> list[Column]:
    return [
        F.col("matched_key").alias("match_key"),
        F.col("data_source_id").alias("source"),
        F.col("matched_authors_text").alias("authors_text"),
        F.col("matched_year").alias("year"),
    ]


def _asked_of_records(signed: DataFrame, found: DataFrame) -> DataFrame:
    """Searches with their forms and what they ask of the records."""
    return signed.join(found, "signature").select(
        "search", "match_key", "year_from", "year_to",
        F.coalesce("author", F.lit(ANY)).alias("author_facet"),
        F.explode(_source_facets()).alias("source_facet"),
        F.coalesce("year_from", "year_to").isNotNull().alias("dated"),
    )


def _valid(facets: DataFrame) -> DataFrame:
    return facets.filter(F.coalesce("species", "infraspecies", "any_epithet").isNotNull())


def _distinct(facets: DataFrame) -> DataFrame:
    """Each search once, stored."""
    return cut(facets.select(*FACETS).distinct().withColumn("search", _search_key()))


def _names_of_searches(
    searches: DataFrame, records: DataFrame, scored: DataFrame, tree: TaxonTree | None
) -> DataFrame:
    """Names found by each of the distinct ``searches``: the first record and their number."""
    signed, found = _forms_found(searches, records, tree)
    groups = _record_groups(searches, _ranked_records(_of_forms(scored, found)))
    hits = (
        _asked_of_records(signed, found)
        .join(groups, ["match_key", "author_facet", "source_facet", "dated"])
        .filter(~F.col("dated") | _in_years(F.col("year")))
    )
    return hits.groupBy("search", "match_key").agg(
        F.min("first").alias("first"), F.sum("n_records").alias("n_records")
    )


def search_batch(
    facets: DataFrame, records: DataFrame, scored: DataFrame, tree: TaxonTree | None = None
) -> DataFrame:
    """Names found by each search: the best record and the number of records.

    ``records`` are prepared, ``scored`` the same with their scores. Equal
    searches are run once.
    """
    valid = _valid(facets)
    names = _names_of_searches(_distinct(valid), records, scored, tree)
    return (
        valid.withColumn("search", _search_key())
        .select("query_id", "search", "all_results")
        .join(names, "search")
        .select(
            "query_id",
            "all_results",
            name_id(F.col("match_key")).alias("id"),
            F.col("match_key").alias("name"),
            F.lit("FacetedSearch").alias("match_type"),
            F.col("first.matched_cardinality").alias("cardinality"),
            "n_records",
            F.col("first.data_source_id").alias("data_source_id"),
            F.col("first.record_id").alias("record_id"),
            F.col("first.matched_name").alias("matched_name"),
            F.col("first.sort_score").alias("sort_score"),
        )
    )


def _source_facets() -> Column:
    chosen = F.transform(F.array_distinct("sources"), lambda s: s.cast("string"))
    return F.coalesce(chosen, F.array(F.lit(ANY)))


def _search_key() -> Column:
    return F.to_json(F.struct(*FACETS))


def _records_of_searches(
    searches: DataFrame, records: DataFrame, scored: DataFrame, tree: TaxonTree | None
) -> DataFrame:
    """All records behind the names of each of the distinct ``searches``."""
    signed, found = _forms_found(searches, records, tree)
    scored = _of_forms(scored, found)
    classes = scored.select(*_class_columns()).distinct()
    hits = (
        _asked_of_records(signed, found)
        .join(_listed(searches, classes), ["match_key", "author_facet", "source_facet"])
        .filter(~F.col("dated") | _in_years(F.col("year")))
        .select("search", "match_key", "source", "authors_text", "year")
        .distinct()
    )
    left, right = hits.alias("h"), _ranked_records(scored).alias("r")
    on = (
        (F.col("h.match_key") == F.col("r.matched_key"))
        & (F.col("h.source") == F.col("r.data_source_id"))
        & (F.col("h.authors_text") == F.col("r.matched_authors_text"))
        & F.col("h.year").eqNullSafe(F.col("r.matched_year"))
    )
    return left.join(right, on).select("h.search", "r.*")


def search_records(
    facets: DataFrame, records: DataFrame, scored: DataFrame, tree: TaxonTree | None = None
) -> DataFrame:
    """All records behind the names of searches that ask for all results."""
    wanted = _valid(facets.filter("all_results"))
    answers = cut(_records_of_searches(_distinct(wanted), records, scored, tree))
    asked = cut(wanted.withColumn("search", _search_key()).select("query_id", "search"))
    return fan_out(asked, answers, "search").drop("search")


def search_placeholder(facets: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each search without hits: the query text and its identifier."""
    empty = facets.join(found.select("query_id").distinct(), "query_id", "left_anti")
    errors = ["error"] if "error" in facets.columns else []
    return empty.select(
        "query_id",
        name_id(F.col("query")).alias("id"),
        F.col("query").alias("name"),
        F.lit("NoMatch").alias("match_type"),
        *errors,
    )


def search_documents(
    facets: DataFrame, records: DataFrame, scored: DataFrame, tree: TaxonTree | None = None,
    vernaculars: DataFrame | None = None, languages: str | Iterable[str] | None = None,
) -> DataFrame:
    """One document for each name that a search finds, as :func:`~taxaloom.operators.results.nest_results`
    gives for names; ``row_id`` is the search's. Searches that ask for all results
    list all records of a name, the others its best alone. A search without
    hits has one document with its text, and its error if it is no valid one.

    Equal searches have equal documents, so these are put together once for each
    distinct search, stored, and then given to all that ask for it. ``listed`` are
    the searches whose records a document lists: its own, or, where an id comes
    several times, all that ask for all results under it.
    """
    valid, told = _valid(facets), partial(_told, records=records, vernaculars=vernaculars, languages=languages)
    names = _names_of_searches(_distinct(valid), records, scored, tree).select(
        "search", F.col("first.matched_cardinality").alias("cardinality"), *[F.col(f"first.{c}").alias(c) for c in RECORD]
    )
    best = told(cut(names).join(_ranked_records(scored), RECORD)).select(
        "search", "matched_key", "cardinality", "curation", result_struct().alias("best_result")
    )
    asked = valid.select("query_id", "all_results", _search_key().alias("search"))
    listed = asked.filter("all_results").groupBy("query_id").agg(F.array_sort(F.collect_list("search")).alias("listed"))
    none = F.array().cast("array<string>")
    asked = cut(asked.join(listed, "query_id", "left").select("query_id", "search", F.coalesce("listed", none).alias("listed")))
    answers = told(_records_of_searches(_distinct(valid.filter("all_results")), records, scored, tree))
    each = asked.select("listed").distinct().select("listed", F.explode("listed").alias("search"))
    lists = each.join(answers, "search").groupBy("listed", "matched_key").agg(in_order().alias("results"))
    found = asked.select("search", "listed").distinct().join(best, "search")
    found = cut(found.join(lists, ["listed", "matched_key"], "left"))
    documents = fan_out(asked, found, "search", "listed").select(
        F.col("query_id").alias("row_id"), name_id(F.col("matched_key")).alias("id"), F.col("matched_key").alias("name"),
        F.lit("FacetedSearch").alias("match_type"), "cardinality", "best_result", "results", "curation",
    )
    answered = asked.join(found.select("search"), "search", "left_semi")
    empty = search_placeholder(valid_searches(facets), answered).select(
        F.col("query_id").alias("row_id"), "id", "name", "match_type", F.lit("NotCurated").alias("curation"), "error"
    )
    none = F.lit(None)
    documents = documents.unionByName(empty, allowMissingColumns=True)
    return documents.withColumns({
        "best_results": F.slice(F.array("best_result"), 1, 0), "data_sources_num": none.cast("long"),
    })


def _told(
    rows: DataFrame, records: DataFrame, vernaculars: DataFrame | None, languages: str | Iterable[str] | None
) -> DataFrame:
    rows = rows.withColumns({"match_type": F.lit("FacetedSearch"), "stem_edit_distance": F.lit(0)})
    return with_vernaculars(resolve_current(rows, records), vernaculars, languages)
