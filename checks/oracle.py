"""DuckDB SQL that states what each query must return.

Written without regard to scale: stages compare all pairs of distinct stems,
ranking scores all pairs of a name and its records. Parts are named tables;
``sql`` puts those a query needs before it.
"""

from __future__ import annotations

import re

from checks.standin import TABLES, duck_table

CONNECTORS = "'and','auct','da','de','der','du','et','ex','in','la','nec','non','sensu','van','von'"
MARKS = "'subsp.','ssp.','var.','f.'"
ENDING = "^(.{3,}?)(orum|arum|ibus|ium|ius|us|um|is|ae|ei|ii|a|e|i|o)$"
CURATION_SCORE = """CASE WHEN data_source_id = 1 THEN 1.0::DOUBLE
  WHEN curation = 'Curated' THEN 2.0::DOUBLE / 3 WHEN curation = 'AutoCurated' THEN 1.0::DOUBLE / 3
  ELSE 0.0::DOUBLE END"""

PARTS: dict[str, str] = {name: duck_table(name) for name in TABLES}


CAPITAL = "[A-Z][\\p{Ll}-]+"


def _is_word(word: str) -> str:
    return f"(regexp_full_match(coalesce({word}, ''), '[\\p{{Ll}}-]{{2,}}') AND {word} NOT IN ({CONNECTORS}))"


def _decomposed(source: str, column: str = "name") -> str:
    return f"""
SELECT * EXCLUDE (toks, rest, kinds, lead_pos, pos, tail_pos, signed, t0, t1, t2, p, mixed, nested),
  named AND mixed AS is_hybrid, CASE WHEN named AND nested THEN regexp_extract(t2[2], '[^()]+') END AS subgenus,
  CASE WHEN named THEN genus0 END AS genus,
  CASE WHEN named THEN list_transform(pos, lambda i: rest[i]) ELSE [] END AS epithets,
  CASE WHEN named THEN 1 + len(pos) ELSE 0 END AS cardinality,
  CASE WHEN named THEN array_to_string([genus0] || list_transform(pos, lambda i: rest[i]), ' ') END AS canonical_simple,
  CASE WHEN named THEN array_to_string([genus0] || list_transform(pos, lambda i:
      CASE WHEN i > 1 AND kinds[i - 1] = 'r' THEN replace(rest[i - 1], 'ssp.', 'subsp.') || ' ' ELSE '' END || rest[i]), ' ') END AS canonical_full,
  CASE WHEN named THEN array_to_string([genus0] || list_transform(pos, lambda i:
      regexp_replace(rest[i], '{ENDING}', '\\1')), ' ') END AS canonical_stem,
  CASE WHEN named THEN coalesce(list_filter(list_transform(pos, lambda i:
      CASE WHEN i > 1 AND kinds[i - 1] = 'r' THEN CASE rest[i - 1] WHEN 'ssp.' THEN 'subsp.' ELSE rest[i - 1] END ELSE '' END),
      lambda m: m <> '')[-1], '') ELSE '' END AS rank,
  CASE WHEN named THEN array_to_string(list_filter(list_transform(
      regexp_split_to_array(regexp_replace(signed, '[0-9]+', '', 'g'), '[(),;&\\[\\]]| (?:ex|in|et|and) '),
      lambda a: trim(a)), lambda a: a <> ''), '|') ELSE '' END AS authors_text,
  CASE WHEN named THEN TRY_CAST(regexp_extract(clean, '\\b((?:1[6-9]|20)[0-9]{{2}})\\b', 1) AS INT) END AS year,
  CASE WHEN NOT named THEN 0
       WHEN len(list_filter(tail_pos, lambda i: kinds[i] = 'e')) > 0 THEN 3
       WHEN regexp_matches(clean, '\\) ?,? ?(?:1[6-9]|20)[0-9]{{2}}') THEN 2 ELSE 1 END AS parse_quality,
  CASE WHEN named THEN array_to_string([genus0] || list_transform(pos, lambda i: rest[i]), ' ')
       WHEN is_virus THEN 'virus:' || lower(clean) ELSE 'verbatim:' || clean END AS match_key
FROM (
  SELECT *, toks[1] AS genus0,
    array_to_string(list_transform(list_filter(tail_pos, lambda i: kinds[i] <> 'e'),
      lambda i: CASE WHEN kinds[i] = 'r' AND list_contains(pos, i + 1) THEN '&' ELSE rest[i] END), ' ') AS signed
  FROM (
    SELECT *, list_filter(range(1, len(rest) + 1), lambda i: i >= lead_pos AND NOT list_contains(pos, i)) AS tail_pos
    FROM (
      SELECT *, list_filter(range(1, len(rest) + 1), lambda i:
          kinds[i] = 'e' AND (i < lead_pos OR (i > 1 AND kinds[i - 1] = 'r'))) AS pos
      FROM (
        SELECT *, coalesce(list_filter(range(1, len(rest) + 1), lambda i:
            kinds[i] IN ('o', 'c') OR (kinds[i] = 'r' AND coalesce(kinds[i + 1], '') <> 'e'))[1], len(rest) + 1) AS lead_pos
        FROM (
          SELECT *, regexp_full_match(toks[1], '{CAPITAL}') AND NOT is_virus AS named,
            list_transform(rest, lambda w: CASE WHEN w IN ({MARKS}) THEN 'r' WHEN w IN ({CONNECTORS}) THEN 'c'
                WHEN regexp_full_match(w, '[\\p{{Ll}}-]{{2,}}') THEN 'e' ELSE 'o' END) AS kinds
          FROM (
            SELECT *, toks[2:] AS rest, clean <> array_to_string(t2, ' ') AS mixed, len(t2) > len(toks) AS nested,
              regexp_matches(clean, '(?i)\\b[a-z]*(virus|viruses|viroid|phage)\\b') AS is_virus
            FROM (
              SELECT *, CASE WHEN regexp_full_match(t2[1], '{CAPITAL}') AND regexp_full_match(coalesce(t2[2], ''), '\\({CAPITAL}\\)')
                  AND {_is_word('t2[3]')} THEN t2[1:1] || t2[3:] ELSE t2 END AS toks
              FROM (
                SELECT *, CASE WHEN NOT regexp_full_match(t1[1], '{CAPITAL}') THEN t1
                    WHEN t1[p] IN ('×', 'x') AND {_is_word('t1[p + 1]')} THEN t1[1:p - 1] || t1[p + 1:]
                    WHEN t1[p] LIKE '×%' AND {_is_word('substr(t1[p], 2)')} THEN t1[1:p - 1] || [substr(t1[p], 2)] || t1[p + 1:]
                    ELSE t1 END AS t2
                FROM (
                  SELECT *, CASE WHEN regexp_full_match(coalesce(t1[2], ''), '\\({CAPITAL}\\)') THEN 3 ELSE 2 END AS p
                  FROM (
                    SELECT *, CASE WHEN t0[1] IN ('×', 'x') AND regexp_full_match(coalesce(t0[2], ''), '{CAPITAL}') THEN t0[2:]
                        WHEN regexp_full_match(t0[1], '×{CAPITAL}') THEN [substr(t0[1], 2)] || t0[2:] ELSE t0 END AS t1
                    FROM (SELECT *, string_split(clean, ' ') AS t0
                          FROM (SELECT *, trim(regexp_replace(coalesce({column}, ''), '\\s+', ' ', 'g')) AS clean
                                FROM {source}))))))))))))
"""


PARTS["nm_all"] = _decomposed("names_in")
PARTS["nm"] = "SELECT * FROM nm_all WHERE clean <> ''"
PARTS["rc"] = f"""SELECT d.*, coalesce(s.curation, 'NotCurated') AS curation, s.title_short, s.updated_at
FROM ({_decomposed('name_records')}) d LEFT JOIN data_sources s ON d.data_source_id = s.id"""
PARTS["keys"] = "SELECT DISTINCT match_key, cardinality, genus, epithets, canonical_stem FROM nm"
PARTS["rkeys"] = """SELECT DISTINCT match_key AS matched_key, canonical_stem AS matched_stem,
  cardinality AS matched_cardinality FROM rc"""
PARTS["rstems"] = "SELECT DISTINCT matched_stem FROM rkeys WHERE matched_cardinality > 0"
PARTS["exact_hits"] = """SELECT match_key, matched_key, 0 AS stage, cardinality AS kept, match_key AS probe, 0 AS sd
FROM keys JOIN rkeys ON match_key = matched_key"""
PARTS["stem_hits"] = """SELECT match_key, matched_key, 1 AS stage, cardinality AS kept, match_key AS probe, 0 AS sd
FROM keys JOIN rkeys ON canonical_stem = matched_stem AND match_key <> matched_key WHERE cardinality > 1"""
PARTS["partial_probes"] = """SELECT DISTINCT match_key, kept, probe FROM (
  SELECT match_key, n + 1 AS kept, genus || ' ' || array_to_string(epithets[1:n], ' ') AS probe
  FROM (SELECT *, unnest(range(1, len(epithets))) AS n FROM keys WHERE cardinality > 2)
  UNION ALL
  SELECT match_key, n + 1, genus || ' ' || array_to_string(epithets[1:n - 1] || [epithets[len(epithets)]], ' ')
  FROM (SELECT *, unnest(range(1, len(epithets))) AS n FROM keys WHERE cardinality > 2))"""
PARTS["partial_hits"] = """SELECT match_key, matched_key, 3 AS stage, kept, probe, 0 AS sd
FROM partial_probes JOIN rkeys ON probe = matched_key"""
PARTS["genus_hits"] = """SELECT match_key, matched_key, 5 AS stage, 1 AS kept, genus AS probe, 0 AS sd
FROM keys JOIN rkeys ON genus = matched_key WHERE cardinality > 1 AND matched_cardinality = 1"""
_STEM_OF = f"""array_to_string([string_split(probe, ' ')[1]] || list_transform(string_split(probe, ' ')[2:],
  lambda e: regexp_replace(e, '{ENDING}', '\\1')), ' ')"""


def _similar(probes: str, stage: int, distance: int) -> str:
    guard = "" if distance > 1 else """
    AND len(list_filter(range(1, len(string_split(stem, ' ')) + 1), lambda i:
      string_split(stem, ' ')[i] <> string_split(matched_stem, ' ')[i]
      AND least(length(string_split(stem, ' ')[i]), length(string_split(matched_stem, ' ')[i])) < 5)) = 0"""
    return f"""SELECT p.match_key, matched_key, {stage} AS stage, kept, probe, sd
FROM (SELECT *, {_STEM_OF} AS stem FROM ({probes})) p
JOIN (SELECT stem, matched_stem, levenshtein(stem, matched_stem) AS sd
      FROM (SELECT DISTINCT {_STEM_OF} AS stem FROM ({probes}))
      JOIN rstems ON abs(length(stem) - length(matched_stem)) <= {distance}
        AND len(string_split(stem, ' ')) = len(string_split(matched_stem, ' '))
      WHERE levenshtein(stem, matched_stem) <= {distance} {guard}) USING (stem)
JOIN rkeys USING (matched_stem)"""


_WHOLE = "SELECT match_key, cardinality AS kept, match_key AS probe FROM keys WHERE cardinality {}"
PARTS["fuzzy_hits"] = _similar(_WHOLE.format("> 1"), 2, 1)
PARTS["relaxed_hits"] = _similar(_WHOLE.format("> 1"), 2, 2)
PARTS["uninomial_hits"] = _similar(_WHOLE.format("= 1"), 2, 1)
PARTS["uninomial_relaxed_hits"] = _similar(_WHOLE.format("= 1"), 2, 2)
PARTS["partial_fuzzy_hits"] = _similar("SELECT * FROM partial_probes", 4, 1)
PARTS["partial_relaxed_hits"] = _similar("SELECT * FROM partial_probes", 4, 2)
PARTS["group_hits"] = """SELECT match_key, matched_key, 0 AS stage, cardinality AS kept, probe, 0 AS sd FROM (
  SELECT match_key, cardinality, match_key AS probe FROM keys WHERE cardinality > 0
  UNION ALL SELECT match_key, cardinality, match_key || ' ' || epithets[1] FROM keys WHERE cardinality = 2
  UNION ALL SELECT match_key, cardinality, genus || ' ' || epithets[1] FROM keys
    WHERE cardinality = 3 AND epithets[1] = epithets[2]) JOIN rkeys ON probe = matched_key"""


def _labelled(hits: str, relaxed: bool = False) -> str:
    suffix = "Relaxed" if relaxed else ""
    return f"""SELECT match_key, matched_key,
  CASE WHEN match_key LIKE 'virus:%' THEN 'Virus' WHEN stage = 0 THEN 'Exact' WHEN stage = 1 THEN 'Fuzzy'
       WHEN stage = 2 THEN 'Fuzzy{suffix}' WHEN stage = 4 THEN 'PartialFuzzy{suffix}' ELSE 'Partial' END AS match_type,
  levenshtein(probe, matched_key) AS edit_distance, sd AS stem_edit_distance FROM ({hits})
QUALIFY row_number() OVER (PARTITION BY match_key, matched_key ORDER BY sd, levenshtein(probe, matched_key)) = 1"""


def _longest(hits: str) -> str:
    return f"""SELECT * FROM ({hits})
QUALIFY rank() OVER (PARTITION BY match_key ORDER BY stage, kept DESC) = 1"""


def _union(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)


PARTS["matched_forms"] = _labelled(_longest(_union(
    "exact_hits", "stem_hits", "fuzzy_hits", "partial_hits", "partial_fuzzy_hits", "genus_hits")))

# Matching against one source only.
PARTS["only_rc"] = "SELECT * FROM rc WHERE data_source_id = 5"
_ONLY = ["rkeys", "rstems", "exact_hits", "stem_hits", "fuzzy_hits", "partial_hits",
         "partial_fuzzy_hits", "genus_hits"]


def _only(text: str) -> str:
    for name in [*_ONLY, "rc"]:
        text = re.sub(rf"\b{name}\b(?!\.)", f"only_{name}", text)
    return text


for _name in _ONLY:
    PARTS[f"only_{_name}"] = _only(PARTS[_name])
PARTS["only_matched"] = _only(PARTS["matched_forms"])

PARTS["profiles"] = """SELECT DISTINCT match_key, cardinality, rank, authors_text, year, """ + \
    """match_key || '|' || rank || '|' || authors_text || CASE WHEN year IS NULL THEN '' ELSE '|' || year END AS profile FROM nm"""
PARTS["rows_in"] = """SELECT row_id, name, match_key,
  match_key || '|' || rank || '|' || authors_text || CASE WHEN year IS NULL THEN '' ELSE '|' || year END AS profile FROM nm"""


def _scored(pairs: str) -> str:
    """Scores of pairs of ``n_*`` and record columns with ``edit_distance``."""
    return f"""SELECT *, (((((((round(cardinality_score * 21)::BIGINT * 22 + round(rank_score * 21)::BIGINT) * 22
    + round(fuzzy_less_score * 21)::BIGINT) * 22 + round(curation_score * 21)::BIGINT) * 22
    + round(authorship_score * 21)::BIGINT) * 22 + round(acceptance_score * 21)::BIGINT) * 22
    + round(parse_quality_score * 21)::BIGINT))::DOUBLE / 2494357888.0::DOUBLE AS sort_score
FROM (SELECT *,
  CASE WHEN n_cardinality = cardinality THEN 1.0::DOUBLE ELSE 0.0 END AS cardinality_score,
  CASE WHEN cardinality < 3 THEN 0.0::DOUBLE WHEN n_rank = '' OR rank = '' THEN 0.5 WHEN n_rank = rank THEN 1.0 ELSE 0.0 END AS rank_score,
  1 - least(edit_distance, 3)::DOUBLE / 3 AS fuzzy_less_score,
  {CURATION_SCORE} AS curation_score,
  CASE WHEN n_authors = '' AND n_year IS NULL THEN CASE WHEN authors_text <> '' OR year IS NOT NULL THEN 2.0::DOUBLE / 7 ELSE 1.0::DOUBLE / 7 END
       WHEN n_authors <> '' AND n_authors = authors_text AND n_year IS NOT DISTINCT FROM year THEN 1.0
       WHEN n_authors <> '' AND n_authors = authors_text THEN 5.0::DOUBLE / 7
       WHEN n_year = year THEN 3.0::DOUBLE / 7
       WHEN authors_text = '' AND year IS NULL THEN 1.0::DOUBLE / 7 ELSE 0.0 END AS authorship_score,
  CASE WHEN is_synonym THEN 0.0::DOUBLE ELSE 1.0 END AS acceptance_score,
  CASE parse_quality WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 2.0::DOUBLE / 3 WHEN 3 THEN 1.0::DOUBLE / 3 ELSE 0.0 END AS parse_quality_score
  FROM ({pairs}))"""


ORDER = "sort_score DESC, matched_name, data_source_id, record_id"
PARTS["pairs"] = _scored("""SELECT p.profile, p.match_key, p.cardinality AS n_cardinality, p.rank AS n_rank,
  p.authors_text AS n_authors, p.year AS n_year, m.matched_key, m.match_type, m.edit_distance, m.stem_edit_distance,
  rc.name AS matched_name, rc.canonical_full, rc.cardinality, rc.rank, rc.authors_text, rc.year, rc.parse_quality,
  rc.data_source_id, rc.record_id, rc.current_record_id, rc.is_synonym, rc.curation, rc.title_short,
  rc.classification_path, rc.classification_ranks, rc.classification_ids, rc.canonical_simple, rc.outlink,
  rc.local_id, rc.entry_date
  FROM profiles p JOIN matched_forms m USING (match_key) JOIN rc ON rc.match_key = m.matched_key""")
PARTS["best0"] = f"SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY profile ORDER BY {ORDER}) = 1"
PARTS["per0"] = f"""SELECT * FROM pairs
QUALIFY row_number() OVER (PARTITION BY profile, data_source_id ORDER BY {ORDER}) = 1"""
_RESOLVED = """SELECT f.*, c.name AS current_name, c.canonical_full AS current_canonical_full,
  c.canonical_simple AS current_canonical_simple, c.cardinality AS current_cardinality,
  CASE WHEN c.name IS NULL THEN 'N/A' WHEN f.is_synonym THEN 'Synonym' ELSE 'Accepted' END AS taxonomic_status
FROM {} f LEFT JOIN rc c ON f.data_source_id = c.data_source_id AND f.current_record_id = c.record_id"""
PARTS["best"] = _RESOLVED.format("best0")
PARTS["per"] = _RESOLVED.format("per0")
PARTS["every"] = _RESOLVED.format("pairs")
PARTS["ties"] = f"""SELECT profile, string_agg(data_source_id || ':' || record_id, '|' ORDER BY {ORDER}) AS tied
FROM (SELECT *, rank() OVER (PARTITION BY profile ORDER BY sort_score DESC) AS place FROM pairs)
WHERE place = 1 GROUP BY profile HAVING count(*) > 1"""
PARTS["common_lists"] = """SELECT data_source_id, record_id, string_agg(language_code || ':' || name, '|' ORDER BY language_code, name) AS common
FROM (SELECT DISTINCT data_source_id, record_id, language_code, name FROM vernaculars WHERE language_code IN ('eng', 'deu'))
GROUP BY data_source_id, record_id"""
PARTS["sources_num"] = """SELECT m.match_key, count(DISTINCT data_source_id) AS data_sources_num
FROM matched_forms m JOIN rc ON rc.match_key = m.matched_key GROUP BY m.match_key"""
PARTS["failed"] = """SELECT row_id, coalesce(name, '') AS name,
  CASE WHEN name IS NULL THEN 'name is missing' ELSE 'name is blank' END AS error
FROM names_in WHERE trim(coalesce(name, '')) = ''"""

_FLAT_VALUES = """printf('%.5f', f.sort_score) AS "SortScore", f.match_type AS "MatchType",
  f.edit_distance::VARCHAR AS "EditDistance", r.name AS "ScientificName", f.matched_name AS "MatchedName",
  coalesce(f.canonical_full, '') AS "MatchedCanonical", f.record_id AS "TaxonId", coalesce(f.current_name, '') AS "CurrentName",
  f.taxonomic_status AS "TaxonomicStatus", f.data_source_id::VARCHAR AS "DataSourceId", f.title_short AS "DataSourceTitle",
  f.classification_path AS "ClassificationPath", '' AS "Error" """
_FLAT_EMPTY = """SELECT row_id, 0::INT AS position, 'SortedMatch' AS "Kind", '0.0' AS "SortScore", 'NoMatch' AS "MatchType",
  '' AS "EditDistance", name AS "ScientificName", '' AS "MatchedName", '' AS "MatchedCanonical", '' AS "TaxonId",
  '' AS "CurrentName", '' AS "TaxonomicStatus", '' AS "DataSourceId", '' AS "DataSourceTitle", '' AS "ClassificationPath", {} AS "Error" """
# A run with options: capitalized names, species groups, uninomials, chosen sources.
PARTS["capital_in"] = "SELECT row_id, name, upper(substr(name, 1, 1)) || substr(name, 2) AS verified FROM names_in"
_OPTED = ["keys", "exact_hits", "stem_hits", "partial_probes", "partial_hits", "genus_hits", "fuzzy_hits", "uninomial_hits",
          "partial_fuzzy_hits", "group_hits", "profiles", "rows_in", "pairs", "best0", "best", "per", "ties", "sources_num"]


def _opted(text: str) -> str:
    for name in [*_OPTED, "nm", "per0", "matched_forms"]:
        text = re.sub(rf"\b{name}\b(?!\.)", f"opt_{name}", text)
    return text


for _name in _OPTED:
    PARTS[f"opt_{_name}"] = _opted(PARTS[_name])
PARTS["opt_nm"] = f"SELECT * FROM ({_decomposed('capital_in', 'verified')}) WHERE clean <> ''"
PARTS["opt_matched_forms"] = _opted(_labelled(_longest(_union(
    "exact_hits", "group_hits", "stem_hits", "fuzzy_hits", "uninomial_hits", "partial_hits", "partial_fuzzy_hits", "genus_hits"))))
PARTS["opt_per0"] = _opted(PARTS["per0"].replace("FROM pairs", "FROM pairs WHERE data_source_id IN (1, 2, 5, 7)"))


def _flat_of(listed: str) -> str:
    return f"""
SELECT row_id, 0::INT AS position, 'BestMatch' AS "Kind", {_FLAT_VALUES} FROM rows_in r JOIN best f USING (profile)
UNION ALL
SELECT row_id, rn::INT AS position, CASE WHEN rn = 1 THEN 'BestMatch' ELSE 'SortedMatch' END, {_FLAT_VALUES}
FROM rows_in r JOIN (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY {ORDER}) AS rn
                     FROM {listed}) f USING (profile)
UNION ALL {_FLAT_EMPTY.format("''")} FROM rows_in WHERE profile NOT IN (SELECT profile FROM best)
UNION ALL {_FLAT_EMPTY.format("error")} FROM failed"""


PARTS["flat"] = _flat_of("per")
PARTS["flat_all"] = _flat_of("every")

# Searches.
def _facet(key: str) -> str:
    return f"nullif(regexp_extract(query, '(^| ){key}:([^ ]+)', 2), '')"


PARTS["nparts"] = """SELECT *, list_filter(string_split(name_text, ' ')[2:], lambda w:
    regexp_full_match(w, '[\\p{Ll}-]{2,}\\.?') AND w NOT IN ('subsp.', 'ssp.', 'var.', 'f.')) AS nwords,
  list_filter(string_split(name_text, ' ')[2:], lambda w: regexp_full_match(w, '-[0-9]{4}|[0-9]{4}-?([0-9]{4})?'))[1] AS nyear,
  list_filter(string_split(name_text, ' ')[2:], lambda w: regexp_matches(w, '^[A-Z]')) AS nauthors
FROM (SELECT *, nullif(trim(regexp_extract(query, '(^| )n:([^:]*)( [a-z]+:|$)', 2)), '') AS name_text FROM searches)"""
PARTS["facets"] = f"""SELECT query_id, query, name_text,
  coalesce({_facet('g')}, string_split(name_text, ' ')[1]) AS genus,
  coalesce({_facet('sp')}, nwords[1]) AS species, coalesce({_facet('isp')}, nwords[2]) AS infraspecies,
  {_facet('asp')} AS any_epithet,
  coalesce({_facet('au')}, nullif(array_to_string(nauthors, ' '), '')) AS author,
  {_facet('tx')} AS taxon,
  coalesce({_facet('all')} LIKE 't%', false) AS all_results,
  list_transform(string_split({_facet('ds')}, ','), lambda s: s::INT) AS sources,
  TRY_CAST(nullif(regexp_extract(coalesce({_facet('y')}, nyear), '^([0-9]{{4}})', 1), '') AS INT) AS year_from,
  TRY_CAST(nullif(regexp_extract(coalesce({_facet('y')}, nyear), '([0-9]{{4}})$', 1), '') AS INT) AS year_to
FROM nparts"""


def _agrees(facet: str, word: str, gender: bool = True) -> str:
    def stem(w: str) -> str:
        return f"regexp_replace({w}, '{ENDING}', '\\1')" if gender else w

    return f"""CASE WHEN {facet} LIKE '%.' OR length({facet}) = 1 THEN starts_with({word}, rtrim({facet}, '.'))
      ELSE {stem(word)} = {stem(facet)} END"""


PARTS["forms"] = "SELECT DISTINCT match_key, genus, epithets FROM rc WHERE cardinality > 1"
PARTS["lineages"] = """SELECT DISTINCT match_key, data_source_id, unnest(string_split(classification_path, '|')) AS taxon
FROM rc WHERE classification_path <> ''"""
PARTS["valid"] = "SELECT * FROM facets WHERE coalesce(species, infraspecies, any_epithet) IS NOT NULL"
PARTS["found_forms"] = f"""SELECT s.*, f.match_key FROM valid s JOIN forms f ON
  (s.genus IS NULL OR {_agrees('s.genus', 'f.genus', gender=False)})
  AND (species IS NULL OR {_agrees('species', 'epithets[1]')})
  AND (infraspecies IS NULL OR len(list_filter(epithets[2:], lambda e: {_agrees('infraspecies', 'e')})) > 0)
  AND (any_epithet IS NULL OR len(list_filter(epithets, lambda e: {_agrees('any_epithet', 'e')})) > 0)
  WHERE s.taxon IS NULL OR EXISTS (SELECT 1 FROM lineages l WHERE l.match_key = f.match_key
    AND l.taxon = s.taxon AND l.data_source_id = coalesce(s.sources[1], 1))"""
PARTS["ranked"] = _scored("""SELECT rc.*, cardinality AS n_cardinality, '' AS n_rank, '' AS n_authors,
  NULL::INT AS n_year, 0 AS edit_distance, name AS matched_name FROM rc""")
PARTS["found"] = f"""SELECT s.query_id, s.all_results, r.* FROM found_forms s JOIN ranked r ON s.match_key = r.match_key
  WHERE (s.author IS NULL OR len(list_filter(string_split(r.authors_text, '|'), lambda a: {_agrees('s.author', 'a', gender=False)})) > 0)
  AND (s.sources IS NULL OR list_contains(s.sources, r.data_source_id))
  AND ((s.year_from IS NULL AND s.year_to IS NULL)
       OR (r.year >= coalesce(s.year_from, 0) AND r.year <= coalesce(s.year_to, 9999)))"""


PARTS["found_current"] = _RESOLVED.format("found")
PARTS["found_listed"] = f"""SELECT *, row_number() OVER (PARTITION BY query_id, match_key ORDER BY {ORDER}) AS rn,
  'FacetedSearch' AS match_type FROM found_current"""
PARTS["found_names"] = "SELECT query_id AS row_id, match_key AS name FROM found GROUP BY ALL"


def uuid5(text: str) -> str:
    digest = f"sha1(unhex('90181196fecf5082a4c1411d4f314cda') || encode({text}))"
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({digest}, 17, 1)) - 1) % 4 + 1, 1)"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3)"
        f" || '-' || {variant} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


def sql(text: str) -> str:
    """``text`` with the parts it names, in order of need."""
    ordered: list[str] = []

    def need(body: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", body):
            if name in PARTS and name not in ordered and PARTS[name] != body:
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(text)
    tables = ",\n".join(f"{name} AS (\n{PARTS[name]}\n)" for name in ordered)
    return f"WITH {tables}\n{text}" if tables else text
