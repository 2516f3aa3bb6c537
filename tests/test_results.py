import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import attach, lookup, match, ranking, results
from taxaloom.plans.verify import build_index, map_checklist, no_match_rows, verify
from taxaloom.session import cut
from taxaloom.sources import readers, writers

SOURCES = "id int, title string, title_short string, curation string, updated_at string"
RECORD = (
    "data_source_id int, record_id string, name string, is_synonym boolean,"
    " current_record_id string, classification_path string, classification_ranks string, outlink string"
)


def tables(frame):
    records = frame([
        (1, "a", "Aus bus Smith, 1900", False, "a", "Life|Aus", "kingdom|genus", "u"),
        (1, "b", "Aus cus", True, "a", "", "", "u"),
        (4, "c", "Aus bus", False, "c", "Life|Aus", "kingdom", "u"),
        (4, "d", "Aus bus Smith", False, "gone", "Life||Aus", "kingdom| |genus", "u"),
    ], RECORD)
    sources = frame([(1, "One", "S1", "Curated", "2024-01-01"), (4, "Four", "S4", "NotCurated", "2024-01-02")], SOURCES)
    names = frame(
        [(0, "Aus bus"), (1, "Aus cus"), (2, "Zus zus"), (3, " "), (4, None), (5, 'Aus bus "Smith", x')],
        "row_id long, name string",
    )
    return names, records, sources


@pytest.fixture(scope="module")
def done(frame):
    return verify(*tables(frame), sources=[1, 4])


@pytest.fixture(scope="module")
def documents(done):
    return cut(done.documents())


def test_flat_rows(documents):
    flat = results.keep_input_order(results.flat_rows(documents)).collect()
    rows = [(r.row_id, r.Kind, r.MatchType, r.TaxonId, r.CurrentName, r.TaxonomicStatus, r.Error) for r in flat]
    assert rows == [
        # The best row, and the first of the results, which is a best match too.
        (0, "BestMatch", "Exact", "a", "Aus bus Smith, 1900", "Accepted", ""),
        (0, "BestMatch", "Exact", "a", "Aus bus Smith, 1900", "Accepted", ""),
        (0, "SortedMatch", "Exact", "d", "", "N/A", ""),
        (1, "BestMatch", "Exact", "b", "Aus bus Smith, 1900", "Synonym", ""),
        (1, "BestMatch", "Exact", "b", "Aus bus Smith, 1900", "Synonym", ""),
        (2, "SortedMatch", "NoMatch", "", "", "", ""),
        (3, "SortedMatch", "NoMatch", "", "", "", "name is blank"),
        (4, "SortedMatch", "NoMatch", "", "", "", "name is missing"),
        (5, "BestMatch", "Exact", "a", "Aus bus Smith, 1900", "Accepted", ""),
        (5, "BestMatch", "Exact", "a", "Aus bus Smith, 1900", "Accepted", ""),
        # In quotes the author is another one: no author beats a wrong one.
        (5, "SortedMatch", "Exact", "c", "Aus bus", "Accepted", ""),
    ]
    assert flat[5].SortScore == "0.0" and len(flat[0].SortScore) == 7
    assert flat[0].EditDistance == "0" and flat[0].DataSourceTitle == "S1"


def test_without_sources_only_the_best(frame):
    kinds = [r.Kind for r in verify(*tables(frame)).flat().filter("row_id < 2").collect()]
    assert kinds == ["BestMatch", "BestMatch"]


def test_index_gives_the_same_rows(frame, documents):
    names, records, sources = tables(frame)
    indexed = verify(names, build_index(records, sources), sources, sources=[1, 4]).flat()
    plain = results.flat_rows(documents)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, indexed.collect()))
    every = {"sources": [0], "all_matches": True}
    plain, indexed = verify(names, records, sources, **every), verify(names, build_index(records, sources), sources, **every)
    assert sorted(map(tuple, plain.flat().collect())) == sorted(map(tuple, indexed.flat().collect()))
    assert sorted(map(tuple, results.flat_rows(plain.documents()).collect())) == sorted(map(tuple, plain.flat().collect()))


def test_delimited_round_trip(documents, spark, tmp_path):
    flat = results.flat_rows(documents)
    for sep in ",\t":
        path = f"{tmp_path}/{ord(sep)}"
        writers.write_delimited(flat, path, sep)
        back = spark.read.csv(path, header=True, sep=sep, escape='"')
        assert back.columns == results.FLAT_COLUMNS and back.count() == 11
        assert back.filter(F.col("ScientificName") == 'Aus bus "Smith", x').count() == 3


def test_json_documents(documents, spark, tmp_path):
    writers.write_json_docs(documents, f"{tmp_path}/docs")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/docs").collect()]
    by_name = {d.get("name"): d for d in lines}
    assert by_name["Aus bus"]["bestResult"]["recordId"] == "a"
    assert [r["recordId"] for r in by_name["Aus bus"]["results"]] == ["a", "d"]
    assert by_name["Aus bus"]["dataSourcesNum"] == 2
    missing = by_name["Zus zus"]
    assert (missing["matchType"], missing["curation"]) == ("NoMatch", "NotCurated")
    assert not {"bestResult", "results", "dataSourcesNum", "error"} & set(missing)
    back = readers.read_result_docs(spark, f"{tmp_path}/docs")
    assert readers.unnest_results(back).filter("result is not null").count() == 5
    writers.write_json_docs(documents, f"{tmp_path}/pretty", pretty=True)
    text = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/pretty", wholetext=True).collect())
    assert text.count("\n") > 100 and '  "matchType" : "NoMatch"' in text


def test_stored_response(spark, tmp_path):
    response = {"metadata": {"namesNumber": 2}, "names": [
        {"id": "x", "name": "Aus bus", "matchType": "Exact", "bestResult": {"dataSourceId": 1, "sortScore": 0.5},
         "results": [{"dataSourceId": 1}, {"dataSourceId": 4}], "dataSourcesNum": 2, "curation": "Curated"},
        {"id": "y", "name": "Zus", "matchType": "NoMatch", "curation": "NotCurated"}]}
    (tmp_path / "r.json").write_text(json.dumps(response) + "\n")
    names = readers.read_result_docs(spark, str(tmp_path), responses=True)
    assert names.count() == 2
    rows = readers.unnest_results(names).orderBy("name", "position").collect()
    assert [(r.name, r.position, r.result and r.result.dataSourceId) for r in rows] == [
        ("Aus bus", 0, 1), ("Aus bus", 1, 4), ("Zus", None, None)]


def test_lineage(frame):
    _, records, _ = tables(frame)
    texts = {r.record_id: r.lineage_text for r in attach.lineage(records).collect()}
    assert texts == {"a": "Life (kingdom) >> Aus (genus)", "b": "", "c": "Life >> Aus",
                     "d": "Life (kingdom) >>  >> Aus (genus)"}


def test_vernaculars_of_synonyms(frame, done):
    common = frame([(1, "a", "bus bird", "English", "eng"), (1, "a", "oiseau", "French", "fra"), (4, "c", "x", "German", "deu")],
                   "data_source_id int, record_id string, name string, language string, language_code string")
    best = cut(done.best())
    found = attach.attach_vernaculars(best, common, ["eng", "german"]).collect()
    assert {(r.record_id, r.vernacular) for r in found} == {("a", "bus bird"), ("b", "bus bird")}
    assert attach.attach_vernaculars(best, common, ["all"]).count() == 4


def test_lookup_by_text_or_identifier(frame):
    _, records, _ = tables(frame)
    ids = frame([("Aus%20bus",), ("Aus cus",), ("b6ca73c5-0000-5000-8000-000000000000",)], "id string")
    found = {(r.input, r.record_id) for r in lookup.lookup_name_strings(ids, records).collect()}
    assert found == {("Aus%20bus", "c"), ("Aus cus", "b")}
    from taxaloom.functions.names import name_id

    by_id = records.filter("record_id = 'a'").select(F.upper(name_id(F.col("name"))).alias("id"))
    assert lookup.lookup_name_strings(by_id, records, [1]).count() == 1
    assert lookup.lookup_name_strings(by_id, records, [4]).count() == 0


def test_checklist_and_no_match(frame, done):
    names, records, sources = tables(frame)
    mapped = map_checklist(names, records, sources, source=4)
    assert {(r.row_id, r.record_id) for r in mapped.collect()} == {(0, "d"), (5, "c")}
    assert [r.row_id for r in no_match_rows(done.names, done.matches).collect()] == [2]


def test_source_stats(frame):
    _, records, sources = tables(frame)
    extra = sources.unionByName(frame([(9, "Nine", "S9", "NotCurated", "2024-01-01")], SOURCES))
    counts = {r.id: r.record_count for r in attach.source_stats(records, extra).collect()}
    assert counts == {1: 2, 4: 2, 9: 0}


def test_flat_rows_without_documents(done, documents):
    plain = results.flat_rows(documents)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, done.flat().collect()))


def test_documents_with_common_names_and_ties(frame, spark, tmp_path):
    names, records, sources = tables(frame)
    common = frame([(1, "a", "bus bird", "English", "eng"), (1, "a", "oiseau", "French", "fra"), (4, "c", "x", "German", "deu")],
                   "data_source_id int, record_id string, name string, language string, language_code string")
    more = records.unionByName(records.filter("record_id = 'a'").withColumn("record_id", F.lit("e")))
    run = verify(names, more, sources, sources="1, 4", vernaculars=common, languages="fra, eng,german")
    writers.write_json_docs(run.documents(), f"{tmp_path}/docs")
    docs = {d.name: d for d in readers.read_result_docs(spark, f"{tmp_path}/docs").collect() if d.name}
    # The synonym has the names of its accepted record.
    assert [(v.name, v.languageCode) for v in docs["Aus cus"].bestResult.vernaculars] == [("bus bird", "eng"), ("oiseau", "fra")]
    assert [r.vernaculars and r.vernaculars[0].name for r in docs["Aus bus"].results] == ["bus bird", None]
    assert [r.recordId for r in docs["Aus bus"].bestResults] == ["a", "e"] and docs["Aus cus"].bestResults is None
    none = verify(names, records, sources, sources="1,x").documents()
    assert none.filter("size(results) = 2").count() == 2  # a bad item voids the list: all sources


def test_exact_strings(frame):
    names, records, _ = tables(frame)
    odd = frame([(9, " Aus\u00a0bus "), (10, "aus bus"), (11, None), (12, "Aus bus")], "row_id long, name string")
    rows = match.match_exact_string(names.unionByName(odd), records).collect()
    assert {(r.row_id, r.record_id, r.match_type) for r in rows} == {
        (0, "c", "Exact"), (1, "b", "Exact"), (9, "c", "Exact"), (12, "c", "Exact")}


def test_best_rows_come_from_the_listed_ones(frame, monkeypatch):
    names, records, sources = tables(frame)
    plain = verify(names, records, sources, sources=[0])
    for every in (False, True):
        run = dataclasses.replace(plain, every=every)
        want = sorted(map(tuple, results.flat_rows(run.documents()).collect()))
        with monkeypatch.context() as patch:
            patch.setattr(ranking, "best_result", None)  # not ranked a second time
            assert sorted(map(tuple, run.flat().collect())) == want
            if not every:
                run.best().collect()
