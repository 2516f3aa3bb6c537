import random

import pytest
from pyspark.sql import functions as F

from conftest import unscalable
from taxaloom.functions.names import decomposed
from taxaloom.operators import ranking, results, search
from taxaloom.session import cut

RECORD = (
    "data_source_id int, record_id string, name string, is_synonym boolean,"
    " current_record_id string, classification_path string, classification_ranks string, outlink string"
)
RECORDS = [
    (1, "1", "Pomatomus saltator (Linnaeus, 1766)"), (1, "2", "Pomatomus saltatrix (Linnaeus, 1766)"),
    (12, "3", "Pomatomus saltator Smith, 1700"), (1, "4", "Plantago major L."), (12, "5", "Plantago majus Hook., 1888"),
    (1, "6", "Caragana arborescens daurica"), (1, "7", "Bubo bubo (Linnaeus, 1758)"), (3, "8", "Bubo bubo bubo"),
]


def facets(frame, *queries):
    return search.extract_facets(frame(list(enumerate(queries)), "query_id int, query string"))


SEARCHES = [
    ("n:Pom. saltator tx:Animalia y:1750-", {"Pomatomus saltator": ("1", 1)}),
    ("g:Plantago asp:major au:Linn.", {}),
    ("g:Plantago asp:major au:L.", {"Plantago major": ("4", 1)}),
    ("g:Plantago asp:major au:L", {"Plantago major": ("4", 1)}),
    ("g:Cara. isp:daurica ds:1,12", {"Caragana arborescens daurica": ("6", 1)}),
    ("sp:salt.", {"Pomatomus saltator": ("1", 2), "Pomatomus saltatrix": ("2", 1)}),
    ("sp:saltator y:1700", {"Pomatomus saltator": ("3", 1)}),
    ("sp:saltator ds:12", {"Pomatomus saltator": ("3", 1)}),
    ("sp:saltator tx:Plantae", {}),
    ("sp:bubo", {"Bubo bubo": ("7", 1), "Bubo bubo bubo": ("8", 1)}),
    ("sp:bubus isp:bubus", {"Bubo bubo bubo": ("8", 1)}),
    ("sp:majus", {"Plantago majus": ("5", 1)}),
    ("sp:bubo", {"Bubo bubo": ("7", 1), "Bubo bubo bubo": ("8", 1)}),
    ("g:Bubo", {}),
    ("sp:saltator all:t", {"Pomatomus saltator": ("1", 2)}),
]


@pytest.fixture
def tables(frame):
    rows = [(*r, False, r[1], "Biota|Animalia" if "Pom" in r[2] else "Biota|Plantae", "", "") for r in RECORDS]
    prepared = decomposed(frame(rows, RECORD))
    sources = frame([(1, "t", "t", "Curated", "2024-01-01")],
                    "id int, title string, title_short string, curation string, updated_at string")
    return prepared, ranking.scored_records(prepared, sources)


@pytest.mark.parametrize("query,expected", [
    ("g:M. sp:gallop. au:Oliv. y:1750-1799", ("M.", "gallop.", None, None, "Oliv.", 1750, 1799, None)),
    ("n:M. gallop. Oliv. 1750-1799", ("M.", "gallop.", None, None, "Oliv.", 1750, 1799, None)),
    ("n:B. bubo Linn. 1758", ("B.", "bubo", None, None, "Linn.", 1758, 1758, None)),
    ("n:Pom. saltator tx:Animalia y:1750-", ("Pom.", "saltator", None, None, None, 1750, None, "Animalia")),
    ("g:Plantago asp:major au:Linn.", ("Plantago", None, None, "major", "Linn.", None, None, None)),
    ("g:Cara. isp:daurica ds:1,12", ("Cara.", None, "daurica", None, None, None, None, None)),
    ("y:-1880 sp:x", (None, "x", None, None, None, None, 1880, None)),
    ("n:Aus bus var. cus g:Dus", ("Dus", "bus", "cus", None, None, None, None, None)),
])
def test_facets(frame, query, expected):
    row = facets(frame, query).first()
    assert (row.genus, row.species, row.infraspecies, row.any_epithet, row.author,
            row.year_from, row.year_to, row.taxon) == expected


def test_sources_and_all(frame):
    row = facets(frame, "g:Cara. isp:daurica ds:1,x,12 all:t").first()
    assert row.sources == [1, 12] and row.all_results
    assert not facets(frame, "sp:a all:false").first().all_results
    assert not facets(frame, "sp:a").first().all_results


def test_valid_searches(frame):
    checked = search.valid_searches(facets(frame, "g:Bubo", "asp:bubo", "n:Bubo bubo", "n:Bubo"))
    assert [r.error is None for r in checked.orderBy("query_id").collect()] == [False, True, True, False]


def test_searches_as_one_job(frame, tables):
    names = search.search_batch(facets(frame, *[q for q, _ in SEARCHES]), *tables)
    assert unscalable(names) == []
    found = {i: {} for i in range(len(SEARCHES))}
    for row in names.collect():
        found[row.query_id][row.name] = (row.record_id, row.n_records)
    for i, (query, expected) in enumerate(SEARCHES):
        assert found[i] == expected, query


def test_all_records_of_a_search(frame, tables):
    asked = facets(frame, "sp:saltator", "sp:saltator all:t", "sp:salt. all:t y:1700-1750")
    found = search.search_records(asked, *tables)
    assert unscalable(found) == []
    rows = {(r.query_id, r.record_id) for r in found.collect()}
    assert rows == {(1, "1"), (1, "3"), (2, "3")}


def test_caller_overrides_sources_and_all(frame, tables):
    asked = search.facet_sources(facets(frame, "sp:saltator ds:1"), [12])
    found = search.search_records(search.facet_all(asked, all_matches=True), *tables)
    assert [r.record_id for r in found.collect()] == ["3"]


def test_placeholder(frame):
    asked = facets(frame, "sp:nihil", "sp:bubo")
    hits = frame([(1,)], "query_id int")
    row = search.search_placeholder(asked, hits).collect()
    assert [(r.query_id, r.name, r.match_type) for r in row] == [(0, "sp:nihil", "NoMatch")]


def test_gender_finds_other_endings(frame):
    words = frame([("alba",), ("albus",), ("album",), ("albicans",)], "word string")
    asked = frame([("alba",), ("alb.",)], "facet string")
    pairs = {(r.facet, r.word) for r in search.facet_words(asked, words, gender=True).collect()}
    assert pairs == {("alba", "alba"), ("alba", "albus"), ("alba", "album")} | {
        ("alb.", w) for w in ("alba", "albus", "album", "albicans")}


def test_short_patterns_meet_each_word_once(frame):
    words = frame([(f"a{i:03d}",) for i in range(300)], "word string")
    assert search.facet_words(frame([("a.",), ("a0.",)], "facet string"), words).count() == 400


FACETS = [
    (search.facet_genus, "g:Pom. sp:x", {"1", "2", "3"}), (search.facet_species, "sp:majus", {"4", "5"} & {"5"}),
    (search.facet_infraspecies, "isp:daurica", {"6"}), (search.facet_any_epithet, "asp:bubo", {"7", "8"}),
    (search.facet_author, "sp:x au:Linn.", {"1", "2", "7"}), (search.facet_year, "sp:x y:1758-1766", {"1", "2", "7"}),
    (search.facet_year, "sp:x y:1888", {"5"}), (search.facet_year, "sp:x y:1766-", {"1", "2", "5"}),
    (search.facet_year, "sp:x y:-1700", {"3"}), (search.facet_year, "sp:x y:1800-1700", set()),
    (search.records_of_sources, "sp:x ds:12,3,12", {"3", "5", "8"}), (search.records_of_sources, "sp:x ds:99", set()),
    (search.facet_taxon, "sp:x tx:Animalia", {"1", "2", "3"}), (search.facet_taxon, "sp:x tx:Biota ds:3", {"8"}),
    (search.facet_taxon, "sp:x tx:Bio", set()),
]


def test_facets_give_records(frame, tables):
    asked = facets(frame, *[q for _, q, _ in FACETS])
    for n, (facet, query, expected) in enumerate(FACETS):
        found = facet(asked.filter(f"query_id = {n}"), tables[0])
        assert unscalable(found) == []
        rows = [r.record_id for r in found.collect()]
        assert set(rows) == expected and len(rows) == len(set(rows)), query


def test_year_blocks_cover_each_year_once(frame):
    ranges = [(a, b) for a in range(0, 40, 3) for b in (a - 1, a, a + 1, a + 7, 1999)] + [(1750, 1799)]
    df = frame(ranges, "first long, last long")
    for r in df.select("first", "last", search._blocks(F.col("first"), F.col("last")).alias("blocks")).collect():
        years = [y for b in r.blocks for y in range(b.block << b.level, b.block + 1 << b.level)]
        assert sorted(years) == list(range(r.first, r.last + 1)) and len(r.blocks) <= 2 * 11


def test_taxa_are_ranges(frame):
    """Names that begin alike, a taxon at two places, and one that is its own parent."""
    rng = random.Random(4)
    taxa = ["A", "AB", "A B", "B", "C", "A|B|C"]
    paths = ["|".join(rng.choice(taxa) for _ in range(rng.randint(1, 5))) for _ in range(400)] + ["", "A||B"]
    rows = [(rng.randint(1, 3), str(i), f"Gen{chr(97 + i % 26)} spe{chr(97 + i // 26)}", False, str(i), p, "", "") for i, p in enumerate(paths)]
    prepared = decomposed(frame(rows, RECORD))
    tree = search.taxon_tree(prepared)
    spans = tree.taxa.collect()
    assert all(r.first <= r.last for r in spans)
    asked = facets(frame, *[f"sp:x tx:{t} ds:{s}" for t in ("A", "AB", "B", "C") for s in (1, 2, 3)])
    got = {(r.query_id, r.record_id) for r in search.facet_taxon(asked, prepared, tree).collect()}
    want = {
        (q, r[1]) for q, (t, s) in enumerate((t, s) for t in ("A", "AB", "B", "C") for s in (1, 2, 3))
        for r in rows if r[0] == s and t in r[5].split("|")
    }
    assert got == want and len(want) > 300


def test_equal_epithets_and_many_authors_store_forms_once(frame, tables, monkeypatch):
    """1,000 searches that differ in their author alone have one signature."""
    stored = []
    monkeypatch.setattr(search, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    asked = facets(frame, *[f"sp:saltator au:A{n}." for n in range(1000)])
    signed, found = search._forms_found(
        cut(asked.select(*search.FACETS).distinct().withColumn("search", search._search_key())), tables[0])
    assert signed.count() == 1000 and found.count() == 1
    assert max(df.count() for df in stored) <= 2


def test_search_documents_and_their_rows(frame, tables):
    asked = facets(frame, "sp:saltator all:t", "sp:salt.", "g:Bubo", "sp:nihil")
    common = frame([(1, "1", "bluefish", "English", "eng")],
                   "data_source_id int, record_id string, name string, language string, language_code string")
    documents = cut(search.search_documents(asked, *tables, vernaculars=common, languages="eng"))
    rows = {(d.row_id, d.name): d for d in documents.collect()}
    assert set(rows) == {(0, "Pomatomus saltator"), (1, "Pomatomus saltator"), (1, "Pomatomus saltatrix"), (2, "g:Bubo"), (3, "sp:nihil")}
    first = rows[0, "Pomatomus saltator"]
    assert first.best_result.record_id == "1" and [r.record_id for r in first.results] == ["1", "3"]
    assert [v.name for v in first.best_result.vernaculars] == ["bluefish"] and first.match_type == "FacetedSearch"
    assert rows[1, "Pomatomus saltator"].results is None and rows[2, "g:Bubo"].error and not rows[3, "sp:nihil"].error
    flat = results.flat_rows(documents).collect()
    assert sorted((r.row_id, r.position, r.Kind, r.TaxonId) for r in flat) == [
        (0, 0, "BestMatch", "1"), (0, 1, "BestMatch", "1"), (0, 2, "SortedMatch", "3"), (1, 0, "BestMatch", "1"),
        (1, 0, "BestMatch", "2"), (2, 0, "SortedMatch", ""), (3, 0, "SortedMatch", "")]


def test_rows_of_one_name_are_ordered_by_search(frame):
    df = frame([(q, "same", str(r)) for q in range(5) for r in range(3)], "query_id int, name string, record_id string")
    got = [(r.query_id, r.record_id) for r in results.order_by_name(df.repartition(4)).collect()]
    assert got == sorted(got)


def test_equal_searches_share_their_documents(frame, tables, monkeypatch):
    stored = []
    monkeypatch.setattr(search, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    asked = facets(frame, *["sp:saltator all:t"] * 40, *["sp:saltator"] * 20)
    documents = search.search_documents(asked, *tables).collect()
    assert max(df.count() for df in stored if "best_result" in df.columns) <= 2
    listed = {d.row_id: [r.record_id for r in d.results or []] for d in documents}
    assert listed == {n: ["1", "3"] if n < 40 else [] for n in range(60)} and len(documents) == 60
    assert {d.best_result.record_id for d in documents} == {"1"}


def test_records_of_one_search_are_shared_by_tasks(frame, spark):
    rows = [(n % 25, str(n), "Bubo bubo L.", False, str(n), "", "", "") for n in range(1500)]
    prepared = cut(decomposed(frame(rows, RECORD)))
    sources = frame([(1, "t", "t", "Curated", "2024-01-01")],
                    "id int, title string, title_short string, curation string, updated_at string")
    asked = cut(facets(frame, *["sp:bubo all:t"] * 1200))
    found = search.search_records(asked, prepared, ranking.scored_records(prepared, sources))
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(tasks) == 1_800_000 and max(tasks) <= 1_400_000
