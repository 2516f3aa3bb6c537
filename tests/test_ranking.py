import itertools
import random
import re

from pyspark.sql import functions as F

from conftest import physical, unscalable
from taxaloom.functions import scores
from taxaloom.operators import ranking
from taxaloom.plans.verify import verify

SOURCES = "id int, title string, title_short string, curation string, updated_at string"
RECORD = (
    "data_source_id int, record_id string, name string, is_synonym boolean,"
    " current_record_id string, classification_path string, classification_ranks string, outlink string"
)


def sources(frame):
    kinds = ["NotCurated", "Curated", "Curated", "AutoCurated", "NotCurated"]
    return frame([(i, f"S{i}", f"S{i}", kinds[i], "2024-01-01") for i in range(1, 5)], SOURCES)


def records(frame, size=160, seed=5):
    """Few forms, many authorships and ranks: half of all records share a form."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        form = rng.choice(["Aus bus", "Aus bus", "Aus bus", "Aus bus {}cus", "Aus bus {}cus", "Aus dus"])
        name = form.format(rng.choice(["", "var. ", "subsp. "]))
        name += rng.choice(["", " Smith", " Smith, 1900", " (Smith) 1900", " Jones, 1900", " Jones & Smith, 1850", " Lee 1850 dubia"])
        rows.append((rng.randint(1, 4), f"{i:04d}", name, rng.random() < 0.3, "0000", "A|B", "x|y", ""))
    return frame(rows, RECORD)


def names(frame):
    forms = ["Aus bus", "Aus bus cus", "Aus bus var. cus", "Aus bus subsp. cus", "Aus dus", "Aus dux"]
    authors = ["", " Smith", " Smith, 1900", " Jones, 1850", " Lee, 1850", " Other, 1700", " 1900"]
    rows = [f + a for f, a in itertools.product(forms, authors)] * 3
    return frame(list(enumerate(rows)), "row_id long, name string")


def run(frame, **options):
    return verify(names(frame), records(frame), sources(frame), **options)


def expected(pairs, *keys):
    """First pair per group when all pairs are scored and sorted."""
    best = {}
    for pair in sorted(pairs, key=lambda p: (-p.sort_score, p.matched_name, p.data_source_id, p.record_id)):
        best.setdefault(tuple(pair[k] for k in keys), pair.record_id)
    return best


def test_index_finds_the_best_of_all_pairs(frame):
    done = run(frame, sources=[0])
    pairs = done.all_matches().collect()
    assert len(pairs) > 1000
    best = {(r.profile,): r.record_id for r in done.best().collect()}
    assert best == expected(pairs, "profile")
    per_source = {(r.profile, r.data_source_id): r.record_id for r in done.per_source().collect()}
    assert per_source == expected(pairs, "profile", "data_source_id")


def test_tied_records(frame):
    done = run(frame)
    pairs = done.all_matches().collect()
    top = {}
    for pair in pairs:
        top[pair.profile] = max(top.get(pair.profile, 0), pair.sort_score)
    ties = {}
    for pair in pairs:
        if pair.sort_score == top[pair.profile]:
            ties.setdefault(pair.profile, set()).add(pair.record_id)
    several = {p: ids for p, ids in ties.items() if len(ids) > 1}
    found = {}
    for row in done.tied().collect():
        found.setdefault(row.profile, set()).add(row.record_id)
    assert several and found == several


def test_sort_score_orders_like_the_components(frame):
    rng = random.Random(1)
    steps = [[0, 1], [0, 0.5, 1], [0, 1 / 3, 2 / 3, 1], [0, 1 / 3, 2 / 3, 1],
             [0, 1 / 7, 2 / 7, 3 / 7, 5 / 7, 1], [0, 1], [0, 1 / 3, 2 / 3, 1]]
    rows = [tuple(float(rng.choice(s)) for s in steps) for _ in range(400)]
    df = frame(rows, ", ".join(f"{c} double" for c in scores.COMPONENTS))
    got = df.withColumn("s", scores.sort_score(*scores.COMPONENTS)).collect()
    for a, b in itertools.combinations(got[:120], 2):
        assert (tuple(a)[:7] < tuple(b)[:7]) == (a.s < b.s)


def test_sources_and_curation(frame):
    done = run(frame)
    held = {r.match_key: r.data_sources_num for r in done.sources_num().collect()}
    assert held["Aus bus"] == 4
    missing = done.best().filter("match_key = 'Aus dux'").count()
    assert missing == 0


def test_bands_and_labels(frame):
    row = (1.0, 0.5, 1.0, 2 / 3, 0.2, 1.0, 2 / 3)
    df = frame([row], ", ".join(f"{c} double" for c in scores.COMPONENTS))
    shown = scores.score_bands(df).first()
    bands = [shown[c.replace("_score", "_band")] for c in scores.COMPONENTS]
    assert bands == ["strong", "weak", "strong", "strong", "weak", "strong", "medium"]
    kinds = [("Exact", 0), ("Fuzzy", 2), ("FuzzyRelaxed", 2), ("Partial", 0), ("Virus", 0), ("NoMatch", 0)]
    labels = [r.label for r in scores.match_labels(frame(kinds, "match_type string, edit_distance int")).collect()]
    assert labels == [
        "Exact match by canonical form", "Fuzzy match, edit distance: 2", "FuzzyRelaxed match",
        "Partial match", "Virus match", "NoMatch",
    ]


def test_plans(frame):
    done = run(frame, sources=[1, 2])
    for df in (done.best(), done.per_source(), done.tied(), done.all_matches(), done.flat()):
        assert unscalable(df) == []


def test_rank_results_has_no_gaps(frame):
    ranked = ranking.rank_results(run(frame, sources=[0]).per_source())
    counts = ranked.groupBy("profile").agg(F.max("rn").alias("m"), F.count("*").alias("n"))
    assert counts.filter("m <> n").count() == 0


def windows_of(df):
    """What the windows of a plan are partitioned by."""
    return re.findall(r"Window \[.*\], \[(.*?)\](?:, \[|\n)", physical(df))


def test_places_of_all_matches(frame):
    """A third of all results is of one profile; no task holds a profile."""
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        profile = "hot" if i % 3 == 0 else f"p{rng.randint(0, 300)}"
        rows.append((profile, rng.choice([0.5, 0.25, 0.75]), f"n{rng.randint(0, 9)}", rng.randint(1, 4), f"{i:05d}"))
    results = frame(rows, "profile string, sort_score double, matched_name string, data_source_id int, record_id string")
    ranked = ranking.rank_results(results.repartition(7))
    assert not any(w.startswith("profile") for w in windows_of(ranked))
    want = {}
    for n, r in enumerate(sorted(rows, key=lambda r: (r[0], -r[1], *r[2:]))):
        want.setdefault(r[0], []).append(r[4])
    got = {}
    for r in ranked.orderBy("profile", "rn").collect():
        got.setdefault(r.profile, []).append(r.record_id)
        assert len(got[r.profile]) == r.rn
    assert got == want
    assert ranking.rank_results(results.limit(0)).count() == 0


def test_all_matches_in_flat_rows_and_documents(frame):
    done = run(frame, sources=[0], all_matches=True)
    pairs = done.all_matches().collect()
    order = lambda p: (-p.sort_score, p.matched_name, p.data_source_id, p.record_id)
    by_profile = {}
    for p in sorted(pairs, key=order):
        by_profile.setdefault(p.profile, []).append(p.record_id)
    profiles = {r.row_id: r.profile for r in done.names.collect()}
    flat = {}
    for r in done.flat().orderBy("row_id", "position").collect():
        flat.setdefault(r.row_id, []).append((r.Kind, r.TaxonId))
    for row_id, profile in profiles.items():
        ids = by_profile.get(profile)
        kinds = ["BestMatch", "BestMatch"] + ["SortedMatch"] * (len(ids or []) - 1)
        want = list(zip(kinds, [ids[0], *ids])) if ids else [("SortedMatch", "")]
        assert flat[row_id] == want
    for d in done.documents().collect():
        assert [r.record_id for r in d.results or []] == by_profile.get(profiles[d.row_id], [])
        tied = [p for p in pairs if p.profile == profiles[d.row_id] and p.sort_score == max(
            q.sort_score for q in pairs if q.profile == p.profile)]
        assert [r.record_id for r in d.best_results or []] == ([p.record_id for p in sorted(tied, key=order)] if len(tied) > 1 else [])


def test_a_hot_form_is_never_paired_off(frame):
    """All names and records share a form: candidates stay within the entries
    of the index, far below the pairs, and the choice is that of all pairs."""
    authors = [f"A{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = [(i % 4 + 1, f"{i:04d}", f"Aus bus {a}, {1700 + i % 50}", i % 3 == 0, "0000", "", "", "")
            for i, a in enumerate(authors)]
    inputs = [(i, f"Aus bus {a}, {1700 + i % 70}") for i, a in enumerate(authors)]
    done = verify(frame(inputs, "row_id long, name string"), frame(rows, RECORD), sources(frame))
    index = ranking.record_index(done.records)
    probes = ranking.with_name_entries(done.profiles.join(done.matches, "match_key"))
    candidates = probes.join(index, ["matched_key", *ranking.ENTRIES]).count()
    assert candidates <= 15 * len(inputs) < len(inputs) * len(rows)
    best = {(r.profile,): r.record_id for r in done.best().collect()}
    assert best == expected(done.all_matches().collect(), "profile")
