"""Every operator as a query over the whole stand-in tables, with its oracle.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLE`` holds the
SQL that must give the same rows. Nested columns are shown as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import oracle as o
from checks.standin import once, spark_table
from taxaloom.functions import scores
from taxaloom.operators import attach, lookup, match, prepare, ranking, results, search
from taxaloom.plans import verify as plan
from taxaloom.session import cut, shared_folder
from taxaloom.sources import readers, writers
from taxaloom.streaming.verify_stream import stream_metrics, verify_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

CHOSEN = [1, 2, 5, 7]  # for the operators that choose sources
EVERY = [0]            # results from all sources


_trees: dict[tuple[str, str], search.TaxonTree] = {}


class Tables:
    """Stand-in tables at one scale; those prepared for matching are stored once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return spark_table(self.spark, self.sf_dir, name)

    @property
    def records(self) -> DataFrame:
        return once(
            self.spark, self.sf_dir, "records", lambda: prepare.prepared_records(self.name_records)
        )

    @property
    def names(self) -> DataFrame:
        return once(
            self.spark, self.sf_dir, "names",
            lambda: prepare.prepared_names(self.names_in).select(*prepare.NAME_COLUMNS),
        )

    @property
    def scored(self) -> DataFrame:
        return ranking.scored_records(self.records, self.data_sources)

    @property
    def tree(self) -> search.TaxonTree:
        """The classifications as intervals, stored once."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _trees:
            _trees[key] = search.taxon_tree(self.records)
        return _trees[key]

    @property
    def keys(self) -> DataFrame:
        return prepare.name_keys(self.names)

    @property
    def record_keys(self) -> DataFrame:
        return prepare.record_keys(self.records)

    @property
    def profiles(self) -> DataFrame:
        return ranking.name_profiles(self.names)

    def matches(self) -> DataFrame:
        """Matches of the cascade, which the ranking queries start from."""
        return once(
            self.spark, self.sf_dir, "matches",
            lambda: match.match_cascade(self.keys, self.record_keys),
        )

    def verification(self, sources: list[int] | None = None, **options) -> plan.Verification:
        return plan.Verification(
            names=self.names, errors=prepare.error_rows(self.names_in), profiles=self.profiles,
            matches=self.matches(), records=self.scored, prepared_records=self.records,
            sources=sources, **options,
        )

    def fresh(self) -> str:
        """A new folder next to other intermediate tables."""
        return f"{shared_folder(self.spark)}/io-{uuid.uuid4().hex}"


def query(oracle: str | None = None, name: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[key] = run
        if oracle:
            ORACLE[key] = o.sql(oracle)
        return build

    return register


def _text(column: str, sep: str = "|"):
    return F.coalesce(F.array_join(column, sep), F.lit("")).alias(column)


# --- Sources and sinks ---------------------------------------------------

@query("SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, trim(coalesce(name, '')) AS name FROM names_in")
def read_name_lines(t: Tables) -> DataFrame:
    path = t.fresh()
    t.names_in.orderBy("row_id").select(F.coalesce("name", F.lit(""))).write.text(path)
    return readers.read_name_lines(t.spark, path)


@query("SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, coalesce(name, '') AS name FROM names_in")
def read_name_column(t: Tables) -> DataFrame:
    path = t.fresh()
    rows = t.names_in.orderBy("row_id")
    rows.select(F.col("row_id") + 1, "name", F.lit("x")).write.csv(
        path, sep="\t", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    read = readers.read_name_column(t.spark, path, sep="\t", name_field=2)
    return read.select("row_id", F.coalesce("name", F.lit("")).alias("name"))


@query("SELECT data_source_id, record_id, name, current_record_id, is_synonym FROM name_records WHERE data_source_id IN (1, 2, 5, 7)")
def read_name_records(t: Tables) -> DataFrame:
    path = t.fresh()
    writers.write_name_records(t.name_records, path)
    stored = readers.read_name_records(t.spark, path, CHOSEN)
    return stored.select("data_source_id", "record_id", "name", "current_record_id", "is_synonym")


@query("SELECT id, title, title_short, curation, updated_at, is_outlink_ready FROM data_sources")
def read_data_sources(t: Tables) -> DataFrame:
    path = t.fresh()
    t.data_sources.select(
        "id", "title", F.col("title_short").alias("titleShort"), "curation",
        F.col("updated_at").alias("updatedAt"), F.col("is_outlink_ready").alias("isOutlinkReady"),
    ).write.json(path)
    return readers.read_data_sources(t.spark, path)


_TOLD = ["local_id", "entry_date", "outlink", "canonical_simple", "current_canonical_simple", "classification_ids"]


def _documents(prefix: str = "", listed: str = "per") -> str:
    """Documents of a run over parts with a prefix, as flat text columns."""
    p = prefix
    told = ", ".join(f"coalesce(f.{c}, '') AS {c}" for c in _TOLD)
    none = ", ".join(f"'' AS {c}" for c in _TOLD)
    return f"""SELECT {o.uuid5('r.name')} AS id, r.name, coalesce(f.match_type, 'NoMatch') AS match_type,
  coalesce(f.curation, 'NotCurated') AS curation, coalesce(n.data_sources_num, 0) AS data_sources_num,
  coalesce(f.record_id, '') AS best_record_id, {told}, coalesce(t.tied, '') AS tied, coalesce(c.common, '') AS common,
  coalesce(l.record_ids, '') AS record_ids, coalesce(l.commons, '') AS commons
FROM {p}rows_in r LEFT JOIN {p}best f USING (profile) LEFT JOIN {p}sources_num n ON n.match_key = r.match_key
LEFT JOIN {p}ties t ON t.profile = r.profile
LEFT JOIN common_lists c ON c.data_source_id = f.data_source_id AND c.record_id = f.current_record_id
LEFT JOIN (SELECT profile, string_agg(x.data_source_id || ':' || x.record_id, '|' ORDER BY {o.ORDER}) AS record_ids,
             string_agg(coalesce(v.common, '-'), ' ' ORDER BY {o.ORDER}) AS commons
           FROM (SELECT profile, data_source_id, record_id, current_record_id, sort_score, matched_name FROM {p}{listed}) x
           LEFT JOIN (SELECT data_source_id AS of_source, record_id AS of_record, common FROM common_lists) v
             ON v.of_source = x.data_source_id AND v.of_record = x.current_record_id
           GROUP BY profile) l ON l.profile = r.profile
UNION ALL SELECT {o.uuid5('r.name')} AS id, r.name, 'NoMatch', 'NotCurated', 0, '', {none}, '', '', '', '' FROM failed r"""


def _read_documents(t: Tables, run: plan.Verification) -> DataFrame:
    """Documents of a run written as JSON and read back."""
    path = t.fresh()
    writers.write_json_docs(run.documents(), path, compression="gzip")
    best = F.col("bestResult")
    ids = lambda r: F.concat_ws(":", r["dataSourceId"].cast("string"), r["recordId"])

    def common(r):
        return F.array_join(F.transform(r["vernaculars"], lambda v: F.concat_ws(":", v["languageCode"], v["name"])), "|")

    shown = {
        "best_record_id": best["recordId"], "local_id": best["localId"], "entry_date": best["entryDate"],
        "outlink": best["outlink"], "canonical_simple": best["matchedCanonicalSimple"],
        "current_canonical_simple": best["currentCanonicalSimple"], "classification_ids": best["classificationIds"],
        "tied": F.array_join(F.transform("bestResults", ids), "|"), "common": common(best),
        "record_ids": F.array_join(F.transform("results", ids), "|"),
        "commons": F.array_join(F.transform("results", lambda r: F.coalesce(common(r), F.lit("-"))), " "),
    }
    return readers.read_result_docs(t.spark, path).select(
        "id", "name", F.col("matchType").alias("match_type"), "curation",
        F.coalesce("dataSourcesNum", F.lit(0)).cast("long").alias("data_sources_num"),
        *[F.coalesce(c, F.lit("")).alias(n) for n, c in shown.items()],
    )


@query(_documents())
def write_json_docs(t: Tables) -> DataFrame:
    return _read_documents(t, t.verification(EVERY, vernaculars=t.vernaculars, languages="eng, deu ,en"))


@query(_documents(listed="every"))
def all_matches_docs(t: Tables) -> DataFrame:
    return _read_documents(t, t.verification(EVERY, every=True, vernaculars=t.vernaculars, languages=["deu", "eng", "german"]))


@query(_documents("opt_"))
def verify_options(t: Tables) -> DataFrame:
    """A whole run with options, to documents; sources and languages as texts."""
    run = plan.verify(
        t.names_in, t.records, t.data_sources, sources="1, 2,5 ,-3,7", capitalize=True, species_group=True,
        uninomials=True, vernaculars=t.vernaculars, languages="eng, deu ,en",
    )
    return _read_documents(t, run)


_RESULTS = "per"


@query(f"""SELECT r.name, (row_number() OVER (PARTITION BY row_id ORDER BY {o.ORDER}) - 1)::INT AS position,
  f.data_source_id, f.record_id, f.matched_name, printf('%.5f', f.sort_score) AS sort_score
FROM rows_in r JOIN {_RESULTS} f USING (profile)
UNION ALL SELECT name, -1, 0, '', '', '' FROM rows_in WHERE profile NOT IN (SELECT profile FROM {_RESULTS})
UNION ALL SELECT name, -1, 0, '', '', '' FROM failed""")
def read_result_docs(t: Tables) -> DataFrame:
    path = t.fresh()
    writers.write_json_docs(t.verification(EVERY).documents(), path, compression="gzip")
    found = readers.unnest_results(readers.read_result_docs(t.spark, path))
    score = F.when(F.col("result").isNotNull(), F.format_string("%.5f", "result.sortScore"))
    return found.select(
        "name", F.coalesce("position", F.lit(-1)).alias("position"),
        F.coalesce("result.dataSourceId", F.lit(0)).alias("data_source_id"),
        F.coalesce("result.recordId", F.lit("")).alias("record_id"),
        F.coalesce("result.matchedName", F.lit("")).alias("matched_name"),
        F.coalesce(score, F.lit("")).alias("sort_score"),
    )


@query("SELECT * FROM flat")
def flat_rows(t: Tables) -> DataFrame:
    return t.verification(EVERY).flat()


@query("SELECT * FROM flat_all")
def flat_rows_all(t: Tables) -> DataFrame:
    return t.verification(EVERY, every=True).flat()


@query("SELECT * EXCLUDE (row_id, position) FROM flat")
def write_delimited(t: Tables) -> DataFrame:
    path = t.fresh()
    writers.write_delimited(t.verification(EVERY).flat(), path, sep="\t", compression="gzip")
    read = t.spark.read.csv(
        path, sep="\t", header=True, escape='"', nullValue="\u0000", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return read.select([F.coalesce(c, F.lit("")).alias(c) for c in read.columns])


# --- Projections and predicates ------------------------------------------

@query("SELECT row_id, trim(name) AS name FROM names_in WHERE trim(name) <> ''")
def clean_names(t: Tables) -> DataFrame:
    return prepare.clean_names(t.names_in)


@query("SELECT row_id, name, upper(substr(name, 1, 1)) || substr(name, 2) AS verified FROM names_in")
def capitalize_names(t: Tables) -> DataFrame:
    return prepare.capitalize_names(t.names_in)


@query(f"SELECT row_id, name, {o.uuid5('name')} AS id FROM names_in")
def name_ids(t: Tables) -> DataFrame:
    return prepare.name_ids(t.names_in)


_DECOMPOSED = """SELECT {id} AS id, coalesce(name, '') AS name, is_hybrid, coalesce(subgenus, '') AS subgenus, coalesce(canonical_full, '') AS canonical_full, coalesce(canonical_simple, '') AS canonical_simple,
  coalesce(canonical_stem, '') AS canonical_stem, cardinality::INT AS cardinality, coalesce(genus, '') AS genus, array_to_string(epithets, '|') AS epithets,
  rank, authors_text, coalesce(year, 0) AS year, parse_quality, is_virus, match_key FROM {table}"""


def _decomposed(df: DataFrame, key: str) -> DataFrame:
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("name", "canonical_full", "canonical_simple", "canonical_stem", "genus", "subgenus")]
    return df.select(
        F.col(key).cast("string").alias("id"), "is_hybrid", *blank, "cardinality", _text("epithets"), "rank",
        "authors_text", F.coalesce("year", F.lit(0)).alias("year"), "parse_quality", "is_virus", "match_key",
    )


@query(_DECOMPOSED.format(id="row_id::VARCHAR", table="nm_all")
       + " UNION ALL " + _DECOMPOSED.format(id="record_id", table="rc"))
def decompose_names(t: Tables) -> DataFrame:
    names = prepare.decompose_names(t.names_in)
    records = prepare.decompose_names(t.name_records)
    return _decomposed(names, "row_id").unionByName(_decomposed(records, "record_id"))


@query("SELECT record_id, canonical_simple, canonical_stem FROM rc ")
def stem_canonicals(t: Tables) -> DataFrame:
    named = t.records.select("record_id", "canonical_simple")
    return prepare.stem_canonicals(named)


@query("SELECT data_source_id, record_id, name FROM name_records WHERE data_source_id IN (1, 2, 5, 7)")
def filter_sources(t: Tables) -> DataFrame:
    kept = prepare.filter_sources(t.name_records, [*CHOSEN, -3])
    return kept.select("data_source_id", "record_id", "name")


@query("""SELECT record_id, coalesce(array_to_string(list_transform(range(1, len(p) + 1), lambda i:
  CASE WHEN len(p) = len(r) AND trim(r[i]) <> '' THEN trim(p[i]) || ' (' || trim(r[i]) || ')' ELSE trim(p[i]) END), ' >> '), '') AS lineage_text,
  coalesce(len(p), 0)::INT AS taxa
FROM (SELECT record_id, CASE WHEN classification_path <> '' THEN string_split(classification_path, '|') END AS p,
             string_split(classification_ranks, '|') AS r FROM name_records)""")
def lineage(t: Tables) -> DataFrame:
    taxa = F.coalesce(F.size("lineage"), F.lit(0))
    return attach.lineage(t.name_records).select(
        "record_id", "lineage_text", F.when(F.col("lineage").isNull(), 0).otherwise(taxa).alias("taxa")
    )


@query("""SELECT match_key, matched_key, CASE match_type WHEN 'Exact' THEN 'Exact match by canonical form'
  WHEN 'Fuzzy' THEN 'Fuzzy match, edit distance: ' || edit_distance WHEN 'PartialFuzzy' THEN 'PartialFuzzy match, edit distance: ' || edit_distance
  ELSE match_type || ' match' END AS label FROM matched_forms
UNION ALL SELECT DISTINCT match_key, '', 'NoMatch' FROM keys WHERE match_key NOT IN (SELECT match_key FROM matched_forms)""")
def match_labels(t: Tables) -> DataFrame:
    none = t.keys.join(t.matches(), "match_key", "left_anti").select(
        "match_key", F.lit("").alias("matched_key"), F.lit("NoMatch").alias("match_type"),
        F.lit(0).alias("edit_distance"),
    )
    all_keys = t.matches().drop("stem_edit_distance").unionByName(none)
    return scores.match_labels(all_keys).select("match_key", "matched_key", "label")


def _band(name: str) -> str:
    weak = 1.0 if name == "rank_score" else 0.3
    strong = "> 0.5" if name == "curation_score" else "= 1"
    return (f"CASE WHEN {name} < {weak} THEN 'weak' WHEN {name} {strong} THEN 'strong' ELSE 'medium' END"
            f" AS {name.replace('_score', '_band')}")


@query(f"SELECT profile, {', '.join(_band(c) for c in scores.COMPONENTS)} FROM best0")
def score_bands(t: Tables) -> DataFrame:
    best = ranking.best_result(t.profiles, t.matches(), t.scored)
    bands = [c.replace("_score", "_band") for c in scores.COMPONENTS]
    return scores.score_bands(best).select("profile", *bands)


# --- Match stages ----------------------------------------------------------

def _per_row(t: Tables, matches: DataFrame) -> DataFrame:
    """Matches of keys as matches of rows; stored first, so that rows of a hot key can be split."""
    return t.names.select("row_id", "match_key").join(cut(matches), "match_key")


_STAGE = """SELECT r.row_id, m.* FROM rows_in r JOIN (SELECT match_key, matched_key, match_type,
  edit_distance::INT AS edit_distance, stem_edit_distance::INT AS stem_edit_distance FROM ({})) m USING (match_key)"""


def _stage(hits: str, relaxed: bool = False) -> str:
    return _STAGE.format(o._labelled(hits, relaxed))


@query("""SELECT row_id, n.name, data_source_id, record_id, 'Exact' AS match_type, 0::INT AS edit_distance, 0::INT AS stem_edit_distance
FROM names_in n JOIN name_records r ON trim(regexp_replace(n.name, '\\s+', ' ', 'g')) = trim(regexp_replace(r.name, '\\s+', ' ', 'g'))""")
def match_exact_string(t: Tables) -> DataFrame:
    return match.match_exact_string(t.names_in, t.name_records).select(
        "row_id", "name", "data_source_id", "record_id", "match_type", "edit_distance", "stem_edit_distance"
    )


@query(_stage("SELECT * FROM exact_hits WHERE kept > 0"))
def match_exact_canonical(t: Tables) -> DataFrame:
    return _per_row(t, match.match_exact_canonical(t.keys, t.record_keys))


@query(_stage("SELECT * FROM stem_hits"))
def match_stem(t: Tables) -> DataFrame:
    return _per_row(t, match.match_stem(t.keys, t.record_keys))


@query(_stage("SELECT * FROM fuzzy_hits"))
def match_fuzzy(t: Tables) -> DataFrame:
    return _per_row(t, match.match_fuzzy(t.keys, t.record_keys))


@query(_stage("SELECT * FROM relaxed_hits", relaxed=True))
def match_fuzzy_relaxed(t: Tables) -> DataFrame:
    return _per_row(t, match.match_fuzzy_relaxed(t.keys, t.record_keys))


@query(_stage("SELECT * FROM uninomial_hits"))
def match_fuzzy_uninomial(t: Tables) -> DataFrame:
    return _per_row(t, match.match_fuzzy_uninomial(t.keys, t.record_keys))


@query(_stage(o._longest("SELECT * FROM partial_hits")))
def match_partial(t: Tables) -> DataFrame:
    return _per_row(t, match.match_partial(t.keys, t.record_keys))


@query(_stage(o._longest("SELECT * FROM partial_fuzzy_hits")))
def match_partial_fuzzy(t: Tables) -> DataFrame:
    return _per_row(t, match.match_partial_fuzzy(t.keys, t.record_keys))


@query(_stage(o._longest("SELECT * FROM partial_relaxed_hits"), relaxed=True))
def match_partial_fuzzy_relaxed(t: Tables) -> DataFrame:
    return _per_row(t, match.match_partial_fuzzy_relaxed(t.keys, t.record_keys))


@query(_stage("SELECT * FROM genus_hits"))
def match_genus_part(t: Tables) -> DataFrame:
    return _per_row(t, match.match_genus_part(t.keys, t.record_keys))


@query(_stage("SELECT * FROM exact_hits WHERE match_key LIKE 'virus:%'"))
def match_virus(t: Tables) -> DataFrame:
    return _per_row(t, match.match_virus(t.keys, t.record_keys))


@query(_stage("SELECT * FROM group_hits"))
def match_species_group(t: Tables) -> DataFrame:
    return _per_row(t, match.match_species_group(t.keys, t.record_keys))


@query(_STAGE.format("SELECT * FROM matched_forms"))
def match_cascade(t: Tables) -> DataFrame:
    return _per_row(t, match.match_cascade(t.keys, t.record_keys))


@query(_STAGE.format(o._labelled(o._longest(o._union(
    "exact_hits", "group_hits", "stem_hits", "relaxed_hits", "uninomial_relaxed_hits", "partial_hits",
    "partial_relaxed_hits", "genus_hits")), relaxed=True)))
def match_cascade_relaxed(t: Tables) -> DataFrame:
    found = match.match_cascade(
        t.keys, t.record_keys, species_group=True, relaxed=True, uninomials=True
    )
    return _per_row(t, found)


@query("SELECT row_id, name, 'NoMatch' AS match_type, 'NotCurated' AS curation FROM rows_in WHERE match_key NOT IN (SELECT match_key FROM matched_forms)")
def no_match_rows(t: Tables) -> DataFrame:
    return plan.no_match_rows(t.names, t.matches())


@query("""SELECT profile, data_source_id, record_id, is_synonym, current_record_id, coalesce(current_name, '') AS current_name,
  coalesce(current_canonical_full, '') AS current_canonical_full, coalesce(current_cardinality, -1)::INT AS current_cardinality,
  taxonomic_status, CASE WHEN current_name <> matched_name THEN current_name ELSE '' END AS shown_name FROM best""")
def resolve_current(t: Tables) -> DataFrame:
    return t.verification().best().select(
        "profile", "data_source_id", "record_id", "is_synonym", "current_record_id",
        F.coalesce("current_name", F.lit("")).alias("current_name"),
        F.coalesce("current_canonical_full", F.lit("")).alias("current_canonical_full"),
        F.coalesce("current_cardinality", F.lit(-1)).alias("current_cardinality"),
        "taxonomic_status", F.coalesce("shown_name", F.lit("")).alias("shown_name"),
    )


@query("""SELECT r.data_source_id, record_id, title_short AS data_source_title, coalesce(curation, 'NotCurated') AS curation, updated_at
FROM name_records r LEFT JOIN data_sources d ON r.data_source_id = d.id""")
def attach_source(t: Tables) -> DataFrame:
    return ranking.attach_source(t.name_records, t.data_sources).select(
        "data_source_id", "record_id", "data_source_title", "curation",
        F.col("updated_at").cast("string").alias("updated_at"),
    )


@query("""SELECT DISTINCT b.data_source_id, b.record_id, b.current_record_id, v.name AS vernacular, v.language, v.language_code
FROM best0 b JOIN vernaculars v ON b.data_source_id = v.data_source_id AND b.current_record_id = v.record_id
WHERE language_code IN ('eng', 'deu')""")
def attach_vernaculars(t: Tables) -> DataFrame:
    best = ranking.best_result(t.profiles, t.matches(), t.scored)
    return attach.attach_vernaculars(best, t.vernaculars, ["eng", "deu", "en"])


@query(f"""SELECT id AS input, record_id, data_source_id, matched_name FROM (
  SELECT DISTINCT CASE row_id % 3 WHEN 0 THEN trim(name) WHEN 1 THEN replace(trim(name), ' ', '%20')
    ELSE {o.uuid5('trim(name)')} END AS id, trim(name) AS name
  FROM names_in WHERE trim(name) <> '') i
JOIN (SELECT name AS matched_name, data_source_id, record_id FROM name_records) r ON i.name = r.matched_name
QUALIFY row_number() OVER (PARTITION BY id, data_source_id ORDER BY record_id) = 1""")
def lookup_name_strings(t: Tables) -> DataFrame:
    names = prepare.clean_names(t.names_in)
    ids = prepare.name_ids(names).select(
        F.when(F.col("row_id") % 3 == 0, F.col("name"))
        .when(F.col("row_id") % 3 == 1, F.replace("name", F.lit(" "), F.lit("%20"))).otherwise(F.col("id")).alias("id")
    )
    return lookup.lookup_name_strings(ids, t.records).select(
        "input", "record_id", "data_source_id", "matched_name"
    )


@query("SELECT id, title, curation FROM data_sources WHERE id IN (SELECT DISTINCT s_nationkey FROM supplier)")
def lookup_sources(t: Tables) -> DataFrame:
    ids = t.spark.read.parquet(f"{t.sf_dir}/supplier.parquet").select(F.col("s_nationkey").alias("id"))
    return attach.lookup_sources(t.data_sources, ids).select("id", "title", "curation")


# --- Aggregations, scores, windows ------------------------------------------

@query("SELECT match_key, data_sources_num FROM sources_num")
def sources_matched(t: Tables) -> DataFrame:
    return attach.sources_matched(t.matches(), t.scored)


@query("SELECT row_id, coalesce(curation, 'NotCurated') AS curation FROM rows_in LEFT JOIN best0 USING (profile)")
def best_curation(t: Tables) -> DataFrame:
    best = ranking.best_result(t.profiles, t.matches(), t.scored)
    return results.best_curation(t.names, best)


@query("""SELECT d.*, coalesce(n, 0) AS record_count FROM data_sources d
LEFT JOIN (SELECT data_source_id, count(*) AS n FROM name_records GROUP BY data_source_id) ON id = data_source_id""")
def source_stats(t: Tables) -> DataFrame:
    return attach.source_stats(t.name_records, t.data_sources)


@query(f"""SELECT r.row_id, {o.uuid5('r.name')} AS id, r.name, coalesce(f.match_type, 'NoMatch') AS match_type,
  coalesce(f.curation, 'NotCurated') AS curation, coalesce(n.data_sources_num, 0) AS data_sources_num,
  coalesce(f.record_id, '') AS best_record_id, coalesce(l.record_ids, '') AS record_ids
FROM rows_in r LEFT JOIN best f USING (profile) LEFT JOIN sources_num n ON n.match_key = r.match_key
LEFT JOIN (SELECT profile, string_agg(data_source_id || ':' || record_id, '|' ORDER BY {o.ORDER}) AS record_ids
           FROM {_RESULTS} GROUP BY profile) l ON l.profile = r.profile""")
def nest_results(t: Tables) -> DataFrame:
    run = t.verification(EVERY)
    nested = results.nest_results(run.names, run.best(), run.per_source(), run.sources_num())
    ids = F.transform(
        "results", lambda r: F.concat_ws(":", r["data_source_id"].cast("string"), r["record_id"])
    )
    return nested.select(
        "row_id", "id", "name", "match_type", "curation", "data_sources_num",
        F.coalesce("best_result.record_id", F.lit("")).alias("best_record_id"),
        F.coalesce(F.array_join(ids, "|"), F.lit("")).alias("record_ids"),
    )


@query("""SELECT count(*) AS names_number, '1|2|5|7' AS data_sources, false AS with_capitalization, true AS with_all_matches FROM names_in""")
def batch_metadata(t: Tables) -> DataFrame:
    return results.batch_metadata(
        t.names_in, CHOSEN, with_capitalization=False, with_all_matches=True
    ).withColumn("data_sources", F.array_join(F.col("data_sources").cast("array<string>"), "|"))


_SCORES = ", ".join(f"printf('%.5f', {c}) AS {c}" for c in [*scores.COMPONENTS, "sort_score"])


def _scores_as_text() -> list:
    return [F.format_string("%.5f", c).alias(c) for c in [*scores.COMPONENTS, "sort_score"]]


@query(f"SELECT profile, matched_key, data_source_id, record_id, {_SCORES} FROM pairs")
def score_matches(t: Tables) -> DataFrame:
    found = t.verification(EVERY).all_matches()
    return found.select("profile", "matched_key", "data_source_id", "record_id", *_scores_as_text())


@query(f"SELECT profile, data_source_id, record_id, (row_number() OVER (PARTITION BY profile ORDER BY {o.ORDER}))::INT AS rn FROM pairs")
def rank_results(t: Tables) -> DataFrame:
    # Ranked rows are stored and dealt out with all their columns, so only with those that are shown or put in order.
    found = t.verification(EVERY).all_matches().select("profile", "sort_score", *ranking.TIES)
    return ranking.rank_results(found).select("profile", "data_source_id", "record_id", "rn")


@query("SELECT row_id, name, data_source_id, record_id, matched_name, match_type, printf('%.5f', sort_score) AS sort_score FROM rows_in JOIN best0 USING (profile)")
def best_result(t: Tables) -> DataFrame:
    run = t.verification()
    found = ranking.best_result(run.profiles, run.matches, run.records)
    return run.per_row(found).select(
        "row_id", "name", "data_source_id", "record_id", "matched_name", "match_type",
        F.format_string("%.5f", "sort_score").alias("sort_score"),
    )


@query("""SELECT profile, data_source_id, record_id, printf('%.5f', sort_score) AS sort_score
FROM (SELECT *, rank() OVER (PARTITION BY profile ORDER BY sort_score DESC) AS place FROM pairs)
WHERE place = 1 QUALIFY count(*) OVER (PARTITION BY profile) > 1""")
def best_results(t: Tables) -> DataFrame:
    return t.verification().tied().select(
        "profile", "data_source_id", "record_id",
        F.format_string("%.5f", "sort_score").alias("sort_score"),
    )


@query("SELECT row_id, data_source_id, record_id, matched_name, match_type, edit_distance::INT AS edit_distance FROM rows_in JOIN per0 USING (profile)")
def best_per_source(t: Tables) -> DataFrame:
    run = t.verification()
    found = ranking.best_per_source(run.profiles, run.matches, run.records)
    return run.per_row(found).select(
        "row_id", "data_source_id", "record_id", "matched_name", "match_type", "edit_distance"
    )


@query("SELECT profile, data_source_id, record_id, match_type, printf('%.5f', sort_score) AS sort_score FROM pairs")
def all_matches(t: Tables) -> DataFrame:
    return t.verification(EVERY).all_matches().select(
        "profile", "data_source_id", "record_id", "match_type",
        F.format_string("%.5f", "sort_score").alias("sort_score"),
    )


@query('SELECT "Kind", "MatchType", count(*) AS n FROM flat GROUP BY ALL')
def row_kinds(t: Tables) -> DataFrame:
    flat = t.verification(EVERY).flat()
    return flat.groupBy("Kind", "MatchType").agg(F.count(F.lit(1)).alias("n"))


_CHECKLIST = o._scored("""SELECT p.profile, p.cardinality AS n_cardinality, p.rank AS n_rank, p.authors_text AS n_authors, p.year AS n_year,
  m.match_type, m.edit_distance, rc.name AS matched_name, rc.cardinality, rc.rank, rc.authors_text, rc.year, rc.parse_quality,
  rc.data_source_id, rc.record_id, rc.is_synonym, rc.curation
  FROM profiles p JOIN only_matched m USING (match_key) JOIN only_rc rc ON rc.match_key = m.matched_key""")


@query(f"""SELECT row_id, record_id, match_type, edit_distance::INT AS edit_distance FROM rows_in
JOIN (SELECT * FROM ({_CHECKLIST}) QUALIFY row_number() OVER (PARTITION BY profile ORDER BY {o.ORDER}) = 1) USING (profile)""")
def map_checklist(t: Tables) -> DataFrame:
    return plan.map_checklist(t.names_in, t.records, t.data_sources, source=5).select(
        "row_id", "record_id", "match_type", "edit_distance"
    )


# --- Order, limits, set operations -------------------------------------------

@query("SELECT * FROM flat ORDER BY row_id, position")
def keep_input_order(t: Tables) -> DataFrame:
    return results.keep_input_order(t.verification(EVERY).flat())


@query("""SELECT rule, row_id, trim(name) AS name FROM (SELECT *, row_number() OVER (ORDER BY row_id) AS place FROM names_in)
JOIN (VALUES ('plain', 5000), ('vernaculars', 50), ('relaxed', 50), ('given', 7)) v(rule, n) ON place <= n WHERE trim(name) <> ''""")
def cap_names(t: Tables) -> DataFrame:
    rules = {"plain": {}, "vernaculars": {"vernaculars": True}, "relaxed": {"relaxed": True}, "given": {"limit": 7, "relaxed": True}}
    parts = [
        prepare.clean_names(prepare.cap_names(t.names_in, **options)).select(F.lit(rule).alias("rule"), "row_id", "name")
        for rule, options in rules.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(_STAGE.format(o._labelled(o._union("exact_hits", "stem_hits", "genus_hits"))))
def union_stages(t: Tables) -> DataFrame:
    stages = match.labelled(match.probe_keys(match.candidates(t.keys, match.exact_probes()), t.record_keys))
    stages = stages.unionByName(match.match_stem(t.keys, t.record_keys))
    return _per_row(t, stages.unionByName(match.match_genus_part(t.keys, t.record_keys)))


@query('SELECT row_id, position, "Kind", "TaxonId" FROM flat')
def best_plus_results(t: Tables) -> DataFrame:
    return t.verification(EVERY).flat().select("row_id", "position", "Kind", "TaxonId")


@query("SELECT name, count(*) AS n_rows FROM names_in GROUP BY name")
def distinct_names(t: Tables) -> DataFrame:
    return prepare.distinct_names(t.names_in)


# --- Faceted search ---------------------------------------------------------

def _facets(t: Tables) -> DataFrame:
    return once(t.spark, t.sf_dir, "facets", lambda: search.extract_facets(t.searches))


_TEXTS = ["genus", "species", "infraspecies", "any_epithet", "author", "taxon", "name_text"]


@query(f"""SELECT query_id, query, {', '.join(f"coalesce({c}, '') AS {c}" for c in _TEXTS)}, all_results,
  coalesce(array_to_string(sources, ','), '') AS sources, coalesce(year_from, 0) AS year_from, coalesce(year_to, 0) AS year_to FROM facets""")
def extract_facets(t: Tables) -> DataFrame:
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in _TEXTS]
    return search.extract_facets(t.searches).select(
        "query_id", "query", *texts, "all_results",
        F.coalesce(F.array_join(F.col("sources").cast("array<string>"), ","), F.lit("")).alias("sources"),
        F.coalesce("year_from", F.lit(0)).alias("year_from"),
        F.coalesce("year_to", F.lit(0)).alias("year_to"),
    )


@query("SELECT query_id, query, CASE WHEN coalesce(species, infraspecies, any_epithet) IS NULL THEN 'the search needs sp:, isp: or asp:' ELSE '' END AS error FROM facets")
def valid_searches(t: Tables) -> DataFrame:
    return search.valid_searches(_facets(t)).select(
        "query_id", "query", F.coalesce("error", F.lit("")).alias("error")
    )


_FOUND = "SELECT query_id, data_source_id, record_id FROM facets JOIN rc ON "


def _some(facet: str, words: str, gender: bool = True) -> str:
    """Records one of whose ``words`` the facet finds."""
    return _FOUND + f"len(list_filter({words}, lambda w: {o._agrees(facet, 'w', gender)})) > 0"


@query(_FOUND + o._agrees("facets.genus", "rc.genus", gender=False))
def facet_genus(t: Tables) -> DataFrame:
    return search.facet_genus(_facets(t), t.records)


@query(_some("species", "epithets[1:1]"))
def facet_species(t: Tables) -> DataFrame:
    return search.facet_species(_facets(t), t.records)


@query(_some("infraspecies", "epithets[2:]"))
def facet_infraspecies(t: Tables) -> DataFrame:
    return search.facet_infraspecies(_facets(t), t.records)


@query(_some("any_epithet", "epithets"))
def facet_any_epithet(t: Tables) -> DataFrame:
    return search.facet_any_epithet(_facets(t), t.records)


@query(f"""SELECT DISTINCT query_id, facet, word, data_source_id, record_id
FROM (SELECT query_id, species AS facet, 1 AS since, 1 AS until FROM facets UNION ALL SELECT query_id, infraspecies, 2, 99 FROM facets
      UNION ALL SELECT query_id, any_epithet, 1, 99 FROM facets) f
JOIN (SELECT data_source_id, record_id, unnest(epithets) AS word, generate_subscripts(epithets, 1) AS place FROM rc) r
  ON place BETWEEN since AND until
WHERE facet NOT LIKE '%.' AND length(facet) > 1 AND facet <> word AND {o._agrees('facet', 'word')}""")
def facet_gender(t: Tables) -> DataFrame:
    return search.facet_gender(_facets(t), t.records)


@query(_some("author", "list_filter(string_split(authors_text, '|'), lambda x: x <> '')", gender=False))
def facet_author(t: Tables) -> DataFrame:
    return search.facet_author(_facets(t), t.records)


@query(_FOUND + """coalesce(year_from, year_to) IS NOT NULL AND rc.year >= coalesce(year_from, rc.year)
  AND rc.year <= coalesce(year_to, rc.year)""")
def facet_year(t: Tables) -> DataFrame:
    return search.facet_year(_facets(t), t.records)


@query("""SELECT query_id, data_source_id, record_id FROM (
  SELECT query_id, unnest(list_distinct(CASE WHEN query_id % 2 = 0 THEN [3, 5] ELSE sources END)) AS chosen FROM facets)
JOIN rc ON chosen = data_source_id""")
def facet_sources(t: Tables) -> DataFrame:
    """Sources of the searches, and for every other one those of the caller in their place."""
    facets = _facets(t)
    chosen = search.facet_sources(facets.filter("query_id % 2 = 0"), [3, 5])
    both = chosen.unionByName(facets.filter("query_id % 2 <> 0"))
    return search.records_of_sources(both, t.records)


@query("""SELECT query_id, rc.data_source_id, rc.record_id FROM facets
JOIN lineages l ON facets.taxon = l.taxon AND l.data_source_id = coalesce(sources[1], 1) JOIN rc ON rc.match_key = l.match_key""")
def facet_taxon(t: Tables) -> DataFrame:
    return search.facet_taxon(_facets(t), t.records, t.tree)


@query("""SELECT query_id, match_key AS name, data_source_id, record_id, printf('%.5f', sort_score) AS sort_score FROM found WHERE all_results""")
def facet_all(t: Tables) -> DataFrame:
    found = search.search_records(search.facet_all(_facets(t)), t.records, t.scored, t.tree)
    return found.select(
        "query_id", F.col("matched_key").alias("name"), "data_source_id", "record_id",
        F.format_string("%.5f", "sort_score").alias("sort_score"),
    )


_SEARCHED = f"""SELECT query_id, all_results, {o.uuid5('match_key')} AS id, match_key AS name, 'FacetedSearch' AS match_type, cardinality::INT AS cardinality,
  n_records, data_source_id, record_id, matched_name, printf('%.5f', sort_score) AS sort_score
FROM (SELECT *, count(*) OVER (PARTITION BY query_id, match_key) AS n_records FROM found)
QUALIFY row_number() OVER (PARTITION BY query_id, match_key ORDER BY {o.ORDER}) = 1"""


def _searched(t: Tables) -> DataFrame:
    found = search.search_batch(_facets(t), t.records, t.scored, t.tree)
    return found.withColumn("sort_score", F.format_string("%.5f", "sort_score"))


@query(_SEARCHED)
def search_batch(t: Tables) -> DataFrame:
    return _searched(t)


@query(_SEARCHED + " ORDER BY name")
def order_by_name(t: Tables) -> DataFrame:
    return results.order_by_name(_searched(t))


_SEARCH_FLAT = f"""
SELECT r.row_id, 0::INT AS position, 'BestMatch' AS "Kind", {o._FLAT_VALUES}
FROM found_names r JOIN found_listed f ON f.query_id = r.row_id AND f.match_key = r.name AND rn = 1
UNION ALL SELECT r.row_id, rn::INT, CASE WHEN rn = 1 THEN 'BestMatch' ELSE 'SortedMatch' END, {o._FLAT_VALUES}
FROM found_names r JOIN found_listed f ON f.query_id = r.row_id AND f.match_key = r.name AND all_results
UNION ALL {o._FLAT_EMPTY.format(
    "CASE WHEN coalesce(species, infraspecies, any_epithet) IS NULL THEN 'the search needs sp:, isp: or asp:' ELSE '' END")}
FROM (SELECT *, query_id AS row_id, query AS name FROM facets) WHERE query_id NOT IN (SELECT query_id FROM found)"""


@query(_SEARCH_FLAT)
def search_docs(t: Tables) -> DataFrame:
    """Searches to documents, and these to flat rows."""
    return results.flat_rows(search.search_documents(_facets(t), t.records, t.scored, t.tree))


@query(f"""SELECT query_id, {o.uuid5('query')} AS id, query AS name, 'NoMatch' AS match_type FROM facets
WHERE query_id NOT IN (SELECT query_id FROM found)""")
def search_placeholder(t: Tables) -> DataFrame:
    return search.search_placeholder(_facets(t), _searched(t))


# --- Streams ------------------------------------------------------------------

@query("SELECT row_id, name, error FROM failed")
def error_rows(t: Tables) -> DataFrame:
    return prepare.error_rows(t.names_in)


def _run_stream(t: Tables, path: str):
    """Four files, a micro-batch each."""
    source = t.fresh()
    names = t.names_stream.select("row_id", "name")
    for part in range(4):
        names.filter(F.col("row_id") % 4 == part).coalesce(1).write.parquet(f"{source}/{part}")
    stream = t.spark.readStream.schema(names.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    run = verify_stream(stream, t.name_records, t.data_sources, path, t.fresh(), trigger={"availableNow": True})
    run.awaitTermination()
    return run


_STREAM_FLAT = (
    o.PARTS["flat"].split("UNION ALL")[0]
    + " UNION ALL " + o._FLAT_EMPTY.format("''") + " FROM rows_in WHERE profile NOT IN (SELECT profile FROM best)"
    + " UNION ALL " + o._FLAT_EMPTY.format("error") + " FROM failed"
)


def _stream_metrics(t: Tables) -> DataFrame:
    path = t.fresh()
    _run_stream(t, path)
    return stream_metrics(t.spark, path).drop("names_per_second")


query("""SELECT row_id % 4 AS batch_id, count(*) AS names, count(*) FILTER (trim(coalesce(name, '')) = '') AS errors
FROM names_stream GROUP BY row_id % 4""", "stream_metrics")(_stream_metrics)


def _verify_stream(t: Tables) -> DataFrame:
    path = t.fresh()
    _run_stream(t, path)
    return t.spark.read.parquet(path).drop("batch")


query(None, "verify_stream")(_verify_stream)
# The batch twin of the stream: the same SQL with the stream's rows as input.
_twin = dict(o.PARTS)
o.PARTS["names_in"] = o.PARTS["names_stream"]
ORACLE["verify_stream"] = o.sql(_STREAM_FLAT)
o.PARTS.clear()
o.PARTS.update(_twin)
