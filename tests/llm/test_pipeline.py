"""The pipeline, sharding and toxicity against plain versions of what they do."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from taxaloom.llm import sharding, toxicity
from tests.llm.test_group_operators import classes, plain_fingerprint
from tests.llm.test_text_operators import VOCABULARY, docs_of, lines_left, words

pytestmark = pytest.mark.filterwarnings("ignore")


# --- pipeline ----------------------------------------------------------------

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, lines_deleted int, key string, body long"


def letters(n):
    return "w" + "".join("abcdefghij"[int(d)] for d in f"{n:04d}")


def tables(spark, folder, texts, labels, items):
    rows = [(i, t, "en", "web", len(t or ""), 7, "k", 1) for i, t in texts]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def plain_passages(text, item, window=13, agree=11):
    """Whether some aligned window agrees, all places tried."""
    split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    d, w = split(text), split(item)
    size = min(window, len(w))
    for shift in range(-len(w), len(d)):
        same = [0 <= i + shift < len(d) and d[i + shift] == x for i, x in enumerate(w)]
        if any(sum(same[s:s + size]) * window >= size * agree for s in range(len(w) - size + 1)):
            return bool(w)
    return False


def plain_pipeline(texts, rejected, items):
    """(id, tokens, text) of what is left of distinct rows, whose ids differ."""
    left = [(i, t) for i, t in texts if not rejected(t or "")]
    # Documents are ordered by id; a null id comes first.
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    cleaned = lines_left([t or "" for _, t in left])
    left = [(i, t if t is None else c) for (i, t), c in zip(left, cleaned)]
    left.sort(key=lambda r: (r[0] is None, r[0] or 0))
    prints = [plain_fingerprint(t) for _, t in left]
    part = classes(len(left), lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 3)
    left = [r for n, r in enumerate(left) if part[n] == n]
    left = [(i, t) for i, t in left if not any(plain_passages(t, item) for _, item in items)]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in left)


def test_pipeline_against_a_plain_one(spark, tmp_path):
    rng = np.random.default_rng(8)
    pool = [" ".join(letters(n) for n in rng.integers(0, 3000, size)) for size in rng.integers(20, 80, 30)]
    passage = " ".join(letters(n) for n in range(4000, 4030))
    texts = []
    for i in range(150):
        t = "\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(1, 4)))
        t += "\n" + " ".join(letters(n) for n in rng.integers(0, 3000, 80))
        if i % 5 == 0:
            t += " vile nasty"
        if i % 11 == 3:
            t += " " + passage.upper()
        texts.append((i, t))
    texts += [(200 + k, texts[k][1] + " extra") for k in range(20)] + [(300 + k, texts[k + 1][1]) for k in range(20)]
    texts += [(400, None), (401, ""), (None, texts[7][1] + " null id"), (402, "<|endoftext|> é😀  "), (403, "very " * 60_000)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(100)] + [(None, 1, 1), (7, None, None)]
    items = [(1, passage), (2, None), (3, "")]
    folder = tables(spark, tmp_path, texts + texts[:3], labels, items)  # three rows stand twice
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rejected = lambda t: plain_probability(model, t) >= 0.25
    assert rejected("vile nasty") and not rejected("clean")
    want = plain_pipeline(texts, rejected, items)
    got = Counter((r.doc_id, r.n_tokens, r.text) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want and 20 < len(got) < 150


def test_pipeline_of_nothing(spark, tmp_path):
    folder = tables(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


# --- toxicity ------------------------------------------------------------------

def plain_probability(model, text):
    found = set(re.findall(r"[^\W\d_]+", text.lower()))
    line = sum(weight for word, weight in model.weights.items() if word in found)
    return 1 / (1 + math.exp(model.thresholds[0] - line))


def test_severity_against_plain_sums(spark):
    model = toxicity.Model({"vile": 2.0, "awful": 1.5, "é": 0.25}, [1.0, 2.5])
    texts = ["VILE vile awful", "vile_awful", "É", "", "clean", "a1vile", "vile " * 100_000]
    rows = {(r.doc_id, r.expected_severity, r.toxic_probability, r.rejected) for r in toxicity.score(docs_of(spark, texts), model).collect()}
    want = set()
    for d, t in {(r.doc_id, r.text or "") for r in docs_of(spark, texts).collect()}:
        line = sum(w for word, w in model.weights.items() if word in re.findall(r"[^\W\d_]+", t.lower()))
        p = [1 / (1 + math.exp(c - line)) for c in model.thresholds]
        want.add((d, round(sum(p), 9), round(p[0], 9), p[0] >= 0.25))
    assert {(d, round(e, 9), round(p, 9), x) for d, e, p, x in rows} == want


def test_ordinal_fit_has_the_least_loss():
    """No small step of any parameter lowers the loss, counted row by row."""
    rng = np.random.default_rng(4)
    rows = [sorted(set(rng.integers(0, 4, rng.integers(0, 4)).tolist())) for _ in range(300)]
    grades = [int(min(2, max(0, round(sum({0: 1.2, 1: 0.6, 2: 0.0, 3: 0.3}[c] for c in r) + rng.normal(0, 0.5))))) for r in rows]
    times = [1] * len(rows)

    def loss(weights, cuts):
        total = 0.0
        for r, g in zip(rows, grades):
            above = [1.0, *(1 / (1 + math.exp(c - sum(weights[i] for i in r))) for c in cuts), 0.0]
            total -= math.log(max(above[g] - above[g + 1], 1e-12)) / len(rows)
        return total + toxicity.SHRINK * sum(w * w for w in weights) / 2

    weights, cuts = toxicity.ordinal_fit(rows, grades, times, 4, 3)
    best = loss(weights, cuts)
    assert cuts == sorted(cuts) and all(w >= 0 for w in weights)
    for i in range(6):
        for step in (-0.05, 0.05):
            moved = [*weights, *cuts]
            moved[i] += step
            if i < 4 and moved[i] < 0:
                continue
            assert loss(moved[:4], moved[4:]) >= best - 1e-6


# --- sharding ------------------------------------------------------------------

def plain_best_fit(sizes, capacity):
    bins, where = [], {}
    for size, item in sizes:
        fits = [(room - size, n) for n, room in enumerate(bins) if room >= size]
        if not fits:
            bins.append(capacity)
            fits = [(capacity - size, len(bins) - 1)]
        _, n = min(fits)
        bins[n] -= size
        where[item] = n
    return where


def test_best_fit_equals_trying_every_bin():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes = sorted(((int(s), n) for n, s in enumerate(rng.integers(1, 60, 80))), key=lambda x: (-x[0], str(x[1])))
        assert sharding.best_fit(sizes, 100) == plain_best_fit(sizes, 100)


def test_shards_of_groups_against_a_plain_packing(spark):
    """Groups of unlike sizes, each large enough to be packed by itself."""
    texts = [words(40 + 3 * k, k) for k in range(40) for _ in range(1 + k % 3)]
    rows = sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).collect()
    groups = Counter(texts)
    sizes = sorted(((n * (len(t.encode()) + 8), t) for t, n in groups.items()), reverse=True)
    assert len({s for s, _ in sizes}) == len(sizes)
    low, best = -(-sum(s for s, _ in sizes) // 4), None
    capacity = low
    while best is None:                       # the least capacity that needs four shards, found one by one
        found = plain_best_fit(sizes, capacity)
        best = found if max(found.values()) < 4 else None
        capacity += 1
    shards = defaultdict(set)
    for r in rows:
        shards[r.shard].add(texts[r.doc_id])
        assert r.size == len(texts[r.doc_id].encode()) + 8
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in shards)
    bytes_of = lambda part: sum(s for s, t in sizes if t in part)
    heaviest = max(bytes_of({t for t, b in best.items() if b == n}) for n in range(4))
    assert sum(map(len, shards.values())) == len(groups)           # no group is divided
    assert max(map(bytes_of, shards.values())) <= heaviest + low // 10_000 + 1


def test_a_large_group_without_ids_is_spread(spark):
    rows = [(None, "same text")] * 4000 + [(k, f"text {k}") for k in range(500)]
    placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 8).collect()
    sizes = Counter()
    for r in placed:
        sizes[r.shard] += r.size
    assert len(placed) == 4500 and len(sizes) == 8 and max(sizes.values()) <= 1.1 * min(sizes.values())
