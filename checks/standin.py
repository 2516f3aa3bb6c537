"""Stand-in tables, built from the supplied ones by one SQL text.

The supplied data holds no scientific names. The same text runs in Spark and
in DuckDB, so both sides of a check start from equal rows. A third of the
records and names use the 64 values of ``p_name`` (hot keys); the others get
a genus and an epithet spelled from the key, so their number grows with the
data. Table names are in braces: data frames in Spark, views in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxaloom.session import cut


def _int(number: str) -> str:
    return f"CAST({number} AS INT)"


def _syllable(number: str) -> str:
    return (
        f"substr('bcdfglmnprstv', {_int(f'{number} % 13 + 1')}, 1)"
        f" || substr('aeiou', {_int(f'{number} % 5 + 1')}, 1)"
    )


def _over(number: str, by: int) -> str:
    return f"CAST(floor({number} / {by}) AS BIGINT)"


def _spelled(number: str) -> str:
    spread = f"({number} * 7919 % {65**4})"
    return " || ".join(_syllable(_over(spread, 65**i)) for i in range(4))


# Genus, epithet and the other pieces of a name, for each part.
PIECES = f"""
SELECT k, data_source_id, p_type, p_size, third, mark, author, author2,
       upper(substr(g, 1, 1)) || substr(g, 2) AS genus, epithet
FROM (
  SELECT p_partkey AS k, CAST(substr(p_brand, 7) AS INT) AS data_source_id,
         p_type, p_size, lower(p_type) AS third,
         CASE p_partkey % 5 WHEN 0 THEN 'var. ' WHEN 1 THEN 'subsp. ' ELSE '' END AS mark,
         CASE p_partkey % 5 WHEN 0 THEN 'Linnaeus' WHEN 1 THEN 'Hooker'
              WHEN 2 THEN 'Smith' WHEN 3 THEN 'Benth.' ELSE 'L.' END AS author,
         CASE p_partkey % 4 WHEN 0 THEN 'Gray' WHEN 1 THEN 'Kunth'
              WHEN 2 THEN 'de Vries' ELSE 'H. Lund' END AS author2,
         CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1)
              ELSE {_spelled(_over('p_partkey', 48))} END AS g,
         CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 2)
              ELSE {_spelled(_over('p_partkey', 4))}
                   || CASE WHEN p_partkey % 4 = 3 THEN 'a' ELSE 'us' END END AS epithet
  FROM {{part}}
) AS words
"""

NAME_RECORDS = f"""
SELECT CAST(data_source_id AS INT) AS data_source_id, CAST(k AS STRING) AS record_id,
       CASE WHEN k % 50 = 49 THEN genus || ' mosaic virus'
            WHEN k % 100 = 57 THEN lower(genus) || ' ' || epithet || ' ' || CAST(k AS STRING)
            WHEN k % 100 = 31 THEN genus || ' (Nidus) ' || epithet || ' ' || author
            ELSE canonical || CASE k % 7
                   WHEN 0 THEN ''
                   WHEN 1 THEN ' ' || author || ', ' || CAST(1750 + p_size AS STRING)
                   WHEN 2 THEN ' (' || author || ', ' || CAST(1750 + p_size AS STRING) || ')'
                   WHEN 3 THEN ' (' || author || ') ' || CAST(1750 + p_size AS STRING)
                   WHEN 4 THEN ' ' || author || ' & ' || author2 || ', '
                               || CAST(1750 + p_size AS STRING)
                   WHEN 5 THEN ' ' || author || ' ex ' || author2
                   ELSE ' ' || author || ', ' || CAST(1750 + p_size AS STRING) || ' dubia' END
       END AS name,
       k % 10 = 0 AND k <> first_key AS is_synonym,
       CASE WHEN k % 10 = 0 THEN CAST(first_key AS STRING)
            ELSE CAST(k AS STRING) END AS current_record_id,
       CASE WHEN k % 11 = 3 THEN ''
            ELSE 'Parts|' || p_type || '|' || genus || '|' || canonical END AS classification_path,
       CASE WHEN k % 6 = 5 THEN 'kingdom|family'
            WHEN k % 9 = 4 THEN 'kingdom||genus|species'
            ELSE 'kingdom|family|genus|species' END AS classification_ranks,
       'https://example.org/' || CAST(k AS STRING) AS outlink,
       CASE WHEN k % 13 = 0 THEN NULL ELSE 'L' || CAST(k AS STRING) END AS local_id,
       CASE WHEN k % 17 = 0 THEN NULL
            ELSE CAST(2000 + p_size AS STRING) || '-01-' || CAST(10 + k % 20 AS STRING) END AS entry_date,
       CASE WHEN k % 11 = 3 THEN ''
            ELSE '0|t' || CAST(p_size AS STRING) || '|g|' || CAST(k AS STRING) END AS classification_ids
FROM (
  SELECT pieces.*, first_key,
         CASE WHEN k % 16 = 0 THEN genus
              WHEN k % 8 = 4 THEN genus || ' ' || epithet || ' ' || mark || third
              WHEN k % 16 = 6 THEN genus || ' ' || epithet || ' ' || mark || epithet
              ELSE genus || ' ' || epithet END AS canonical
  FROM ({PIECES}) AS pieces
  JOIN (SELECT p_brand AS brand, min(p_partkey) AS first_key FROM {{part}} AS part
        GROUP BY p_brand) AS firsts
    ON brand = 'Brand#' || CAST(data_source_id AS STRING)
) AS named
"""

NAMES_IN = f"""
SELECT o_orderkey AS row_id,
       CASE o_orderkey % 21
         WHEN 0 THEN binomial
         WHEN 1 THEN lower(substr(binomial, 1, 1)) || substr(binomial, 2)
         WHEN 2 THEN genus || ' ' || typo
         WHEN 3 THEN substr(genus, 1, 1) || 'z' || substr(genus, 3) || ' ' || typo
         WHEN 4 THEN binomial || ' spider'
         WHEN 5 THEN genus || ' ignotissimus'
         WHEN 6 THEN binomial || ' ' || author || ', ' || CAST(1750 + p_size AS STRING)
         WHEN 7 THEN substr(genus, 1, 3) || 'x' || substr(genus, 4)
         WHEN 8 THEN binomial || ' ' || epithet
         WHEN 9 THEN o_orderpriority || ' not a name'
         WHEN 10 THEN genus || ' ' || substr(epithet, 1, 8) || 'um'
         WHEN 11 THEN CASE o_orderkey % 4 WHEN 1 THEN '  ' WHEN 3 THEN NULL ELSE '' END
         WHEN 12 THEN '  ' || genus || '   ' || epithet || ' '
         WHEN 13 THEN genus || ' ' || typo || ' spider'
         WHEN 14 THEN upper(genus) || ' mosaic virus'
         WHEN 15 THEN binomial || ' var. ' || third || ' ' || author2 || ', 1800'
         WHEN 16 THEN genus || ' novellus ' || epithet
         WHEN 17 THEN substr(genus, 1, 1) || 'z' || substr(genus, 3) || ' ' || typo || ' spider'
         WHEN 18 THEN genus || ' (' || upper(substr(epithet, 1, 1)) || substr(epithet, 2, 4) || ') ' || epithet
         WHEN 19 THEN CASE o_orderkey % 4 WHEN 0 THEN genus || ' × ' || epithet
                WHEN 1 THEN genus || ' ×' || epithet || ' ' || author WHEN 2 THEN genus || ' x ' || epithet
                ELSE '×' || genus || ' ' || epithet END
         ELSE genus || ' ' || substr(epithet, 1, 3) || 'üöü' END AS name
FROM (
  SELECT pieces.*, o_orderkey, o_orderpriority, genus || ' ' || epithet AS binomial,
         substr(epithet, 1, 3) || 'x' || substr(epithet, 4) AS typo
  FROM {{orders}} AS orders JOIN ({PIECES}) AS pieces ON o_custkey = k
) AS drafts
"""

DATA_SOURCES = """
SELECT id, 'Checklist ' || CAST(id AS STRING) AS title,
       'CL' || CAST(id AS STRING) AS title_short,
       CASE WHEN id = 1 OR id % 5 = 0 THEN 'Curated'
            WHEN id % 7 = 0 THEN 'AutoCurated' ELSE 'NotCurated' END AS curation,
       '2024-01-' || CASE WHEN id < 10 THEN '0' ELSE '' END || CAST(id AS STRING) AS updated_at,
       id % 2 = 0 AS is_outlink_ready
FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS id FROM {part}) AS brands
"""

VERNACULARS = """
SELECT CAST(substr(p_brand, 7) AS INT) AS data_source_id, CAST(l_partkey AS STRING) AS record_id,
       'common ' || substr(s_name, 10) AS name,
       CASE s_nationkey % 5 WHEN 0 THEN 'English' WHEN 1 THEN 'Spanish' WHEN 2 THEN 'French'
            WHEN 3 THEN 'German' ELSE 'Russian' END AS language,
       CASE s_nationkey % 5 WHEN 0 THEN 'eng' WHEN 1 THEN 'spa' WHEN 2 THEN 'fra'
            WHEN 3 THEN 'deu' ELSE 'rus' END AS language_code
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {lineitem}) AS links
JOIN {supplier} AS supplier ON l_suppkey = s_suppkey
JOIN {part} AS part ON l_partkey = p_partkey
"""

# One search per customer, in the 20 forms of the query language.
SEARCHES = f"""
SELECT c_custkey AS query_id,
       CASE c_custkey % 20
         WHEN 0 THEN 'g:' || genus || ' sp:' || epithet
         WHEN 1 THEN 'g:' || substr(genus, 1, 3) || '. sp:' || epithet
         WHEN 2 THEN 'g:' || genus || ' sp:' || substr(epithet, 1, 3) || '.'
         WHEN 3 THEN 'g:' || genus || ' isp:' || third
         WHEN 4 THEN 'g:' || genus || ' asp:' || substr(epithet, 1, 4) || '.'
         WHEN 5 THEN 'asp:' || epithet || ' au:' || substr(author, 1, 2) || '.'
         WHEN 6 THEN 'sp:' || epithet || ' y:' || CAST(1750 + p_size AS STRING)
         WHEN 7 THEN 'sp:' || epithet || ' y:' || CAST(1750 + p_size AS STRING) || '-1790'
         WHEN 8 THEN 'sp:' || epithet || ' y:1770-'
         WHEN 9 THEN 'sp:' || epithet || ' y:-1770 all:t'
         WHEN 10 THEN 'sp:' || epithet || ' ds:' || CAST(data_source_id AS STRING) || ',1'
         WHEN 11 THEN 'sp:' || epithet || ' tx:' || p_type
         WHEN 12 THEN 'sp:' || epithet || ' tx:' || genus || ' ds:' || CAST(data_source_id AS STRING)
         WHEN 13 THEN 'g:' || genus || ' sp:' || epithet || ' all:true'
         WHEN 14 THEN 'n:' || genus || ' ' || epithet
         WHEN 15 THEN 'n:' || substr(genus, 1, 2) || '. ' || substr(epithet, 1, 4) || '. '
                      || author || ' 1750-1800'
         WHEN 16 THEN 'g:' || genus || ' au:' || author
         WHEN 17 THEN 'sp:nihilissimus g:' || genus
         WHEN 18 THEN 'g:' || genus || ' sp:' || epithet || 'um au:' || substr(author, 1, 1)
         ELSE 'n:' || genus || ' ' || epithet || ' ' || third || ' all:false' END AS query
FROM {{customer}} AS customer JOIN ({PIECES}) AS pieces ON c_custkey = k
"""

NAMES_STREAM = f"""
SELECT event_id AS row_id, ts,
       CASE event_id % 4 WHEN 0 THEN genus || ' ' || epithet
            WHEN 1 THEN genus || ' ' || substr(epithet, 1, 3) || 'x' || substr(epithet, 4)
            WHEN 2 THEN genus || ' ' || epithet || ' ' || event_type
            ELSE CASE event_id % 3 WHEN 0 THEN ' ' ELSE event_type END END AS name
FROM {{events}} AS events JOIN ({PIECES}) AS pieces ON user_id = k
"""

TABLES = {
    "name_records": NAME_RECORDS,
    "names_in": NAMES_IN,
    "data_sources": DATA_SOURCES,
    "vernaculars": VERNACULARS,
    "searches": SEARCHES,
    "names_stream": NAMES_STREAM,
}
SUPPLIED = ["part", "orders", "lineitem", "supplier", "customer", "events"]


_written: dict[tuple[str, str, str], DataFrame] = {}


def once(spark: SparkSession, sf_dir: str, table: str, build) -> DataFrame:
    """``build()`` written to the shared folder once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _written:
        _written[key] = cut(build())
    return _written[key]


def spark_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One stand-in table. The supplied files are small single ones, so the
    rows are spread for the tasks that follow."""
    parts = spark.sparkContext.defaultParallelism
    return once(spark, sf_dir, table, lambda: _built(spark, sf_dir, table).repartition(parts))


def _built(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    text = TABLES[table]
    frames = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in SUPPLIED
        if "{" + name + "}" in text
    }
    return spark.sql(text, **frames)


def duck_table(table: str) -> str:
    """The same table as a DuckDB subquery over the registered views."""
    return TABLES[table].format(**{name: name for name in SUPPLIED})
