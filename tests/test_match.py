import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import unscalable
from taxaloom.functions.names import decomposed
from taxaloom.operators import fuzzy, match, prepare
from taxaloom.operators.fuzzy import deletions, half_deletions, spread_stems, stem_neighbours


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def neighbours(frame, left, right, far, guard):
    stems = frame([(s,) for s in sorted(set(left))], "stem string")
    others = frame([(s,) for s in sorted(set(right))], "matched_stem string")
    return stem_neighbours(stems, spread_stems(others, "matched_stem", far), far, guard)


@pytest.mark.parametrize("far", [1, 2])
def test_similarity_join_equals_all_pairs(frame, far):
    rng = random.Random(7)

    def word():
        return "".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))

    left = {f"{word()} {word()}" for _ in range(150)} | {word() for _ in range(40)}
    right = {f"{word()} {word()}" for _ in range(150)} | {word() for _ in range(40)}
    expected = {
        (a, b, distance(a, b)) for a in left for b in right
        if distance(a, b) <= far and a.count(" ") == b.count(" ")
    }
    found = neighbours(frame, left, right, far, guard=False)
    assert {tuple(r) for r in found.select("stem", "matched_stem", "stem_edit_distance").collect()} == expected
    assert unscalable(found) == []
    if far == 1:
        guarded = {
            (a, b) for a, b, _ in expected
            if all(x == y or min(len(x), len(y)) >= 5 for x, y in zip(a.split(), b.split()))
        }
        found = neighbours(frame, left, right, far, guard=True)
        assert {(r.stem, r.matched_stem) for r in found.collect()} == guarded


def test_no_stem_join_group_grows_with_a_common_genus(frame):
    """A genus in every stem: traces still meet only those of close stems."""
    rng = random.Random(3)
    stems = {"Commongenus " + "".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(2000)}
    traces = spread_stems(frame([(s,) for s in stems], "matched_stem string"), "matched_stem", 1)
    largest = traces.groupBy("trace").count().agg({"count": "max"}).first()[0]
    assert largest < 10


def test_halves_have_few_keys(frame):
    stems = frame([("Abcdefghij klmnopqrst",), ("Ab c",), ("Ab",), ("A",)], "stem string")
    for size, slack in ((lambda n: n + 4, 0), (lambda n: 5 * n + 12, 2)):
        counts = half_deletions(stems, "stem", slack).groupBy("stem").count().collect()
        assert all(r["count"] <= size(len(r.stem)) for r in counts) and len(counts) == 4
    assert deletions(stems, "stem", 2).filter("length(stem) > 9").count() > 200


def test_halves_that_many_stems_share(frame, monkeypatch):
    """A genus in every stem is no key; the result stays that of all pairs."""
    monkeypatch.setattr(fuzzy, "CROWDED", 10)
    rng = random.Random(11)
    right = {"Commongenus " + "".join(rng.choice("abcd") for _ in range(rng.randint(4, 8))) for _ in range(300)}
    left = {s[:k] + rng.choice(["", "x"]) + s[k + rng.randint(0, 1):] for s in list(right)[:80] for k in (3, len(s) - 2)}
    expected = {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= 2 and a.count(" ") == b.count(" ")}
    traces = spread_stems(frame([(s,) for s in right], "matched_stem string"), "matched_stem", 2)
    assert traces.filter("matched_stem IS NULL").count() > 0
    assert traces.filter("matched_stem IS NOT NULL").groupBy("trace").count().agg({"count": "max"}).first()[0] < 60
    found = neighbours(frame, left, right, 2, guard=False)
    assert {tuple(r) for r in found.select("stem", "matched_stem", "stem_edit_distance").collect()} == expected


@pytest.mark.parametrize("far", [1, 2])
def test_words_of_documents_against_a_sample_of_all_pairs(frame, spark, far):
    """The English words of the supplied documents; a sample of them is held against all."""
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001") + "/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    texts = spark.read.parquet(path).filter("lang = 'en'").select(F.lower("text").alias("text"))
    found = texts.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]+"), 0)).alias("w")).distinct()
    every = sorted(r.w for r in found.collect())
    assert len(every) > 500
    sample = every[::len(every) // 40]
    expected = {(a, b, d) for a in sample for b in every if abs(len(a) - len(b)) <= far and (d := distance(a, b)) <= far}
    rows = neighbours(frame, sample, every, far, guard=False).select("stem", "matched_stem", "stem_edit_distance")
    assert {tuple(r) for r in rows.collect()} == expected


RECORDS = [
    "Adiantum davidii var. longispinum", "Pardosa moesta Banks, 1892", "Bubo bubo (Linnaeus, 1758)",
    "Bubo bubo bubo", "Bubo", "Plantago major L.", "Pomatomus saltatrix", "Pomatomus",
    "Tobacco mosaic virus", "Nomen bbo", "Achillea millefolium", "Achillea millefolia lanulosa",
]


def keys_of(frame, names):
    rows = frame(list(enumerate(names)), "row_id long, name string")
    return prepare.name_keys(prepare.prepared_names(rows))


def record_keys_of(frame, names=RECORDS):
    return prepare.record_keys(decomposed(frame([(n,) for n in names], "name string")))


def matches(frame, names, **options):
    found = match.match_cascade(keys_of(frame, names), record_keys_of(frame), **options)
    by_key = {}
    for r in found.collect():
        row = (r.matched_key, r.match_type, r.edit_distance, r.stem_edit_distance)
        by_key.setdefault(r.match_key, set()).add(row)
    return by_key


STAGES = {
    "Bubo bubo L.": ("Bubo bubo", ("Bubo bubo", "Exact", 0, 0)),
    # An exact name brings no similar, partial or genus matches along.
    "Bubo bubo bubo": ("Bubo bubo bubo", ("Bubo bubo bubo", "Exact", 0, 0)),
    "Adiantum davidii Franchet var. longispina Ching": (
        "Adiantum davidii longispina", ("Adiantum davidii longispinum", "Fuzzy", 2, 0)),
    "Odiantum davidii Franchet var. longispina Ching": (
        "Odiantum davidii longispina", ("Adiantum davidii longispinum", "Fuzzy", 3, 1)),
    "Pardosa moesta spider": ("Pardosa moesta spider", ("Pardosa moesta", "Partial", 0, 0)),
    "Pardosa novella moesta": ("Pardosa novella moesta", ("Pardosa moesta", "Partial", 0, 0)),
    "Pardosax moesta spider": ("Pardosax moesta spider", ("Pardosa moesta", "PartialFuzzy", 1, 1)),
    "Pomatomus ignotissimus": ("Pomatomus ignotissimus", ("Pomatomus", "Partial", 0, 0)),
    "tobacco Mosaic VIRUS": (
        "virus:tobacco mosaic virus", ("virus:tobacco mosaic virus", "Virus", 0, 0)),
    "Achillea millefolia lanulosa alpina": (
        "Achillea millefolia lanulosa alpina", ("Achillea millefolia lanulosa", "Partial", 0, 0)),
    # Short words and uninomials are not matched by similarity.
    "Nomen bxbo": ("Nomen bxbo", None),
    "Pomatmus": ("Pomatmus", None),
}


def test_cascade_stages(frame):
    found = matches(frame, list(STAGES))
    for name, (key, row) in STAGES.items():
        assert found.get(key, set()) == ({row} if row else set()), name


def test_options(frame):
    found = matches(
        frame, ["Nomen bxbo", "Pomatmus", "Bubo bubo", "Bubo bubo bubo"],
        relaxed=True, uninomials=True, species_group=True,
    )
    assert {m[:2] for m in found["Nomen bxbo"]} == {("Nomen bbo", "FuzzyRelaxed")}
    assert {m[:2] for m in found["Pomatmus"]} == {("Pomatomus", "FuzzyRelaxed")}
    both = {("Bubo bubo", "Exact"), ("Bubo bubo bubo", "Exact")}
    assert {m[:2] for m in found["Bubo bubo"]} == both
    assert {m[:2] for m in found["Bubo bubo bubo"]} == both
    strict = matches(frame, ["Pomatmus"], uninomials=True)
    assert {m[:2] for m in strict["Pomatmus"]} == {("Pomatomus", "Fuzzy")}


@pytest.mark.parametrize("stage", [
    match.match_exact_canonical, match.match_stem, match.match_fuzzy, match.match_fuzzy_relaxed,
    match.match_fuzzy_uninomial, match.match_partial, match.match_partial_fuzzy,
    match.match_partial_fuzzy_relaxed, match.match_genus_part, match.match_virus,
    match.match_species_group, match.match_cascade,
])
def test_stage_plans(frame, stage):
    keys, records = keys_of(frame, RECORDS), record_keys_of(frame)
    assert unscalable(stage(keys, records)) == []
