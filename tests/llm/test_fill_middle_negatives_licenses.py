import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import fill_middle, hard_negatives, license_scan
from tests.llm.test_text_operators import DOCS, docs_of

pytestmark = pytest.mark.filterwarnings("ignore")


# --- fill in middle ------------------------------------------------------------

ODD = ["abc def\n1\r\n2", "<P> stands here", "x <S", "ÄÖ é́😀 Zz", "a" * 5000, " " * 300, "Aa1bB2\u0000 ", "<", "ab<P", ">"]


@pytest.mark.parametrize("text", [*ODD, "", "long words and 12 numbers, " * 3000])
def test_skip_list_reaches_every_rank(text):
    units = [m.span() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
    found = fill_middle.SkipList(fill_middle.unit_widths(text))
    assert found.size == len(units)
    ranks = range(len(units)) if len(units) < 500 else np.random.default_rng(1).integers(0, len(units), 500).tolist()
    assert [found.place(r) for r in ranks] == [units[r][0] for r in ranks]
    assert found.place(len(units)) == len(text)
    if len(units) > 1000:
        assert len(found.lanes) > 2 and found.lanes[-1][0].sum() == len(units)


def test_units_across_blocks(monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 3)
    for text in [*ODD, "abcdefg", "ab cdefg h"]:
        assert fill_middle.unit_widths(text).tolist() == [len(m[0]) for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]


def plain_transform(doc_id, text):
    """The contract, straight from a list of units."""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", text, None, None
    if h[3] % 100 < 20:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_outputs_are_those_of_the_contract_and_come_back(spark):
    docs = docs_of(spark, [*ODD * 12, "w<P" * 40_000])
    made = fill_middle.fill_in_middle(docs)
    rows = made.select("*", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    given = Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert Counter((r.doc_id, r.back) for r in rows) == given
    assert Counter((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in rows) == Counter({
        (d, *plain_transform(d, t)): n for (d, t), n in given.items()
    })
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0


def test_marks_that_could_arise_at_a_cut_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("<P<", "<S>", "<M>"), ("<P", "<PS", "<M")):
        with pytest.raises(ValueError):
            fill_middle.check_marks(marks)


# --- hard negatives --------------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<float>, score int, anchor string"


def plain_negatives(rows, is_anchor, positives=5, negatives=10):
    sound = [
        (i, lb, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lb, v in rows
        if i is not None and lb is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    anchors = {(i, lb, tuple(v)) for i, lb, v in sound if is_anchor(i)}
    for i, lb, v in anchors:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, l2) for j, l2, w in sound)
        for s, j, _ in [x for x in scored if x[2] == lb and x[1] != i][:positives]:
            good = [x for x in scored if x[2] != lb and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out.update((i, j, n + 1, k, -s, -t) for n, (t, k, _) in enumerate(good))
    return out


def mined(frame):
    return Counter(
        (r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect()
    )


def test_lookups_give_the_exact_inner_product():
    rng = np.random.default_rng(1)
    for dims, most in ((1, 3), (8, 200), (13, 300), (64, 90), (70, 5000), (16, 1 << 24)):
        a, c = rng.integers(-most, most + 1, (9, dims)), rng.integers(-most, most + 1, (31, dims))
        tables = hard_negatives.subset_sums(a)
        got = hard_negatives.inner_products(tables, hard_negatives.bit_planes(c, len(tables)))
        assert (got == c @ a.T).all()
    assert hard_negatives.bit_planes(np.zeros((2, 3), np.int64), 1).shape == (1, 1, 2)


@pytest.mark.parametrize("tile, chunk, block", [(256, 512, 4096), (3, 7, 4)])
def test_negatives_against_brute_force(spark, monkeypatch, tile, chunk, block):
    for name, value in (("TILE", tile), ("CHUNK", chunk), ("BLOCK", block)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(0, 4)), rng.normal(0.2, 0.3, 20).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + k, k % 3, rows[5][2]) for k in range(150)]               # copies: ties
    rows += [rows[10], rows[20], (20, 1, rows[7][2])]                         # repeated rows, an id with two contents
    rows += [(600, None, rows[1][2]), (620, 1, None), (640, 1, [None] * 20), (660, 1, [float("nan")] * 20),
             (680, 2, [float("inf")] + [0.1] * 19), (None, 1, rows[2][2]), (700, 2, []), (720, 2, rows[3][2][:9]),
             (740, 1, [*rows[4][2], 3.0, -2.0])]
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], VECTORS).repartition(3)
    got = mined(hard_negatives.mine(table, F.col("id") % 20 == 0))
    assert got == plain_negatives(rows, lambda i: i % 20 == 0) and len(got) > 500


def test_no_anchors_no_positives_no_negatives(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none, F.col("id") % 2 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [0.5], 1, "x"), (1, 2, [0.4], 1, "x")], VECTORS)
    assert hard_negatives.mine(one, F.col("id") % 2 == 0).count() == 0
    assert hard_negatives.mine(one, F.col("id") == 5).count() == 0


# --- licenses ----------------------------------------------------------------------

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(words):
    return sorted(
        (k, label) for label, phrase in license_scan.BASE
        for p in [phrase.split()] for k in range(len(words)) if words[k:k + len(p)] == p
    )


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(rng, phrase, edits):
    for _ in range(edits):
        at, how = int(rng.integers(1, len(phrase) - 1)), rng.integers(0, 3)
        phrase = phrase[:at] + ("" if how == 0 else "q") + phrase[at + (how != 2):]
    return phrase


def test_distance():
    assert distance("mit license", "mit licence") == 1 and distance("abc", "") == 3 and distance("kitten", "sitting") == 3


def test_notices_with_edits_are_found_and_others_are_not(spark):
    rng = np.random.default_rng(3)
    notices = [*license_scan.BASE, *license_scan.FURTHER]
    fill = [f"zz{k}" for k in range(50)] + ["Ünï", "42"]
    texts, planted = [], []
    for k in range(400):
        label, phrase = notices[k % len(notices)]
        allowed = license_scan.edits_allowed(phrase)
        edits = int(rng.integers(0, allowed + 3))
        changed = edited(rng, phrase, edits)
        before, after = (" ".join(rng.choice(fill, 5)) for _ in range(2))
        texts.append(f"{before} {changed.title()}, {after}")
        planted.append((label, phrase, changed))
    rows = {r.doc_id: r for r in license_scan.scan(docs_of(spark, texts)).collect() if r.doc_id is not None}
    for k, (label, phrase, changed) in enumerate(planted):
        allowed, plain = license_scan.edits_allowed(phrase), license_scan.folded(texts[k])
        words = plain.split()
        # The least distance of the notice to whole words of the text, by trying all.
        near = min(
            distance(phrase, " ".join(words[a:b])) for a in range(4, 7) for b in range(a + 1, len(words))
            if abs(sum(map(len, words[a:b])) + b - a - 1 - len(phrase)) <= allowed + 1
        ) if allowed else (0 if f" {phrase} " in f" {plain} " else 99)
        hit = [h for h in rows[k].hits if h.phrase == phrase]
        assert bool(hit) == (near <= allowed), (phrase, changed)
        if hit:
            h = hit[0]
            assert h.edits == near and h.label == label
            shown = " ".join(words[h.first_word:h.last_word + 1])
            assert distance(phrase, shown) == near
            assert license_scan.folded(texts[k][h.start:h.end]) == shown
            assert h.base == (near == 0 and (label, phrase) in license_scan.BASE)


def test_base_places_against_counting(spark):
    texts = [
        "MIT License", "mit-license MIT\nLICENSE; permit license", "the GNU General Public License, the gnu general public license.",
        "cc by 4.0, CC BY-NC, cc  by", "Apache  License apache license apache licence", "öCC by cc byö cc by", "mit licenses", "",
        "KKCC BY İ", "cc by " * 30_000, "a apache apache license",
    ]
    docs = docs_of(spark, texts)
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count()
    given = Counter((r.doc_id, r.text or "") for r in docs.collect())
    by_id = {r.doc_id: r for r in rows}
    for doc_id, text in given:
        words = plain_words(text)
        r = by_id[doc_id]
        assert r.n_words == len(words)
        assert sorted((h.first_word, h.label) for h in r.hits if h.base) == plain_base(words)
    assert [h.edits for h in by_id[4].hits] == [0, 0, 1] and by_id[7].hits == []
    assert by_id[9].hits[-1].start == 6 * 29_999
    assert license_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_labels(spark):
    hits = spark.createDataFrame([([("mit",), ("apache",), ("mit",)],), ([],)], "hits array<struct<label string>>")
    assert [r[0] for r in hits.select(license_scan.labels_in(F.col("hits"))).collect()] == ["apache,mit", ""]
