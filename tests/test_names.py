import uuid

import pytest
from pyspark.sql import functions as F

from taxaloom.functions import names as fn
from taxaloom.functions.text import language_codes, source_ids
from taxaloom.operators import prepare

# name, canonical_full, stem, cardinality, rank, authors, year, quality
CASES = [
    ("Plantago major L.", "Plantago major", "Plantago major", 2, "", "L.", None, 1),
    ("Pomatomus saltatrix (Linnaeus, 1766)", "Pomatomus saltatrix", "Pomatomus saltatrix", 2, "",
     "Linnaeus", 1766, 1),
    ("Bubo bubo (Linnaeus) 1758", "Bubo bubo", "Bubo bub", 2, "", "Linnaeus", 1758, 2),
    ("Adiantum davidii Franchet var. longispina Ching", "Adiantum davidii var. longispina",
     "Adiantum david longispin", 3, "var.", "Franchet|Ching", None, 1),
    ("Adiantum davidii var. longispinum", "Adiantum davidii var. longispinum",
     "Adiantum david longispin", 3, "var.", "", None, 1),
    ("Racomitrium canescens f. epilosum (H. Müll. ex Milde) G. Jones in Grout",
     "Racomitrium canescens f. epilosum", "Racomitrium canescens epilos", 3, "f.",
     "H. Müll.|Milde|G. Jones|Grout", None, 1),
    ("Pardosa moesta spider", "Pardosa moesta spider", "Pardosa moest spider", 3, "", "", None, 1),
    ("Aus bus ssp. cus", "Aus bus subsp. cus", "Aus bus cus", 3, "subsp.", "", None, 1),
    ("Aus bus de Vries & Smith, 1900 dubia", "Aus bus", "Aus bus", 2, "", "de Vries|Smith", 1900, 3),
    ("Aus bus Hook. f. ex Benth.", "Aus bus", "Aus bus", 2, "", "Hook. f.|Benth.", None, 1),
    ("  Aus \t bus ", "Aus bus", "Aus bus", 2, "", "", None, 1),
    ("Aus", "Aus", "Aus", 1, "", "", None, 1),
]


def test_decomposition(frame):
    df = frame([(c[0],) for c in CASES], "name string")
    got = {r["name"]: r for r in fn.decomposed(df).collect()}
    for name, full, stem, cardinality, rank, authors, year, quality in CASES:
        row = got[name]
        found = (row.canonical_full, row.canonical_stem, row.cardinality, row["rank"],
                 row.authors_text, row.year, row.parse_quality)
        assert found == (full, stem, cardinality, rank, authors, year, quality), name


@pytest.mark.parametrize("name,key", [
    ("Tobacco  Mosaic virus", "virus:tobacco mosaic virus"),
    ("bubo bubo", "verbatim:bubo bubo"),
    ("2-HIGH not a name", "verbatim:2-HIGH not a name"),
])
def test_names_without_canonical_form(frame, name, key):
    row = fn.decomposed(frame([(name,)], "name string")).first()
    assert (row.match_key, row.cardinality, row.parse_quality) == (key, 0, 0)
    assert row.canonical_full is None


def test_name_identifiers(frame):
    texts = ["NotAName", "Plantago major L.", "Müll. ß", ""]
    space = uuid.UUID(fn.NAME_NAMESPACE)
    got = [r.id for r in frame([(t,) for t in texts], "name string").select(
        fn.name_id(F.col("name")).alias("id")).collect()]
    assert got == [str(uuid.uuid5(space, t)) for t in texts]
    assert got[0] == "045a466e-1aba-5024-ad4e-fe9d3bf21fa2"


def test_clean_capitalize_errors(frame):
    df = frame([(0, " bubo bubo "), (1, " \t"), (2, None), (3, "")], "row_id long, name string")
    assert [r.name for r in prepare.clean_names(df).collect()] == ["bubo bubo"]
    shown = prepare.capitalize_names(prepare.clean_names(df)).first()
    assert (shown.name, shown.verified) == ("bubo bubo", "Bubo bubo")
    errors = {r.row_id: r.error for r in prepare.error_rows(df).collect()}
    assert errors == {1: "name is blank", 2: "name is missing", 3: "name is blank"}


@pytest.mark.parametrize("text,loose,strict", [
    ("1,11,180", [1, 11, 180], [1, 11, 180]),
    (" 1 , 11 , 180 ", [1, 11, 180], [1, 11, 180]),
    ("1,abc,180", [1, 180], None),
    ("1,-5,180", [1, 180], [1, 180]),
])
def test_source_lists(frame, text, loose, strict):
    row = frame([(text,)], "t string").select(
        source_ids(F.col("t")).alias("loose"), source_ids(F.col("t"), strict=True).alias("strict")
    ).first()
    assert (row.loose, row.strict) == (loose, strict)


@pytest.mark.parametrize("text,codes", [
    ("eng, deu , rus", ["eng", "deu", "rus"]), ("en,german,rus", ["rus"]), ("all", ["all"]),
])
def test_languages(frame, text, codes):
    assert frame([(text,)], "t string").select(language_codes(F.col("t"))).first()[0] == codes


def test_filter_sources(frame):
    records = frame([(i,) for i in range(5)], "data_source_id int")
    assert prepare.filter_sources(records, [0]).count() == 5
    assert prepare.filter_sources(records, None).count() == 5
    assert prepare.filter_sources(records, [1, -5, 3]).count() == 2


def test_cap_counts_before_blanks_are_dropped(frame):
    df = frame([(i, "" if i % 2 else f"Aus{i}") for i in range(10)], "row_id long, name string")
    assert prepare.clean_names(prepare.cap_names(df, 4)).count() == 2


def test_more_than_a_hundred_epithets_are_kept(frame):
    from taxaloom.functions.names import decomposed

    name = "Aus " + " ".join(f"{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k % 10]}albus" for k in range(130))
    row = fn.decomposed(frame([(name,)], "name string")).first()
    assert row.cardinality == 131 and len(row.epithets) == 130


def test_unicode_spaces_are_spaces(frame):
    from taxaloom.operators.prepare import clean_names, error_rows

    names = frame([(1, " Aus bus "), (2, "  ")], "row_id long, name string")
    assert [r.name for r in clean_names(names).collect()] == ["Aus bus"]
    assert [r.row_id for r in error_rows(names).collect()] == [2]


@pytest.mark.parametrize("name,key,subgenus,hybrid", [
    ("Bus (Cus) albus", "Bus albus", "Cus", False), ("Bus (Cus) albus L., 1758", "Bus albus", "Cus", False),
    ("Bus × albus", "Bus albus", None, True), ("Bus ×albus Smith", "Bus albus", None, True), ("Bus x albus", "Bus albus", None, True),
    ("Bus (Cus) × albus", "Bus albus", "Cus", True), ("× Bus albus", "Bus albus", None, True), ("×Bus", "Bus", None, True),
    ("Bus müelleri", "Bus müelleri", None, False), ("Bus (Smith) 1900", "Bus", None, False),
    ("Bus (Smith) ex Jones", "Bus", None, False), ("Bus albus (Smith, 1900)", "Bus albus", None, False),
    ("Büs albus var. nïger", "Büs albus nïger", None, False), (None, "verbatim:", None, False), ("  ", "verbatim:", None, False),
])
def test_subgenera_hybrids_and_accents(frame, name, key, subgenus, hybrid):
    row = fn.decomposed(frame([(name,)], "name string")).first()
    assert (row.match_key, row.subgenus, row.is_hybrid) == (key, subgenus, hybrid)
