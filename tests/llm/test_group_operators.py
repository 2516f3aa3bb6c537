import re

import numpy as np
import pytest
import xxhash

from taxaloom.llm import graph, sharding, simhash
from tests.llm.test_text_operators import DOCS, docs_of, words

pytestmark = pytest.mark.filterwarnings("ignore")


def classes(n, linked):
    part = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    return part


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100 + k, 101 + k) for k in range(30)] + [(5, 5)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    part = classes(140, lambda i, j: (i, j) in links or (j, i) in links)
    assert got == {i: part[i] for link in links if link[0] != link[1] for i in link}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_golay_words_are_within_three_bits_of_their_codeword():
    table = simhash.golay_table()
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 23, 2000)
    own, near = simhash.near_codewords(table, x)
    sizes = (near >= 0).sum(1)
    assert set(sizes) <= {1, 6}
    flipped = x ^ (1 << rng.integers(0, 23, 2000))
    assert all(o in set(k) for o, k in zip(table[flipped], near))


def test_all_links_of_fingerprints_are_found(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-(1 << 62), 1 << 62, 15)
    prints = [int(s) for s in seeds]
    for s in seeds:                                   # chains that leave their first by many bits
        x = int(s)
        for _ in range(12):
            for b in rng.integers(0, 63, rng.integers(1, 5)):
                x ^= 1 << int(b)
            prints.append(x)
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    part = {r.id: r.component for r in graph.components(simhash.fingerprint_links(nodes)).collect()}
    want = classes(len(prints), lambda i, j: bin((prints[i] ^ prints[j]) & (2**64 - 1)).count("1") <= 3)
    assert [part.get(p, p) for p in prints] == [prints[w] for w in want]


def test_near_duplicates_table(spark):
    base = words(300).split()
    edited = " ".join([*base[:299], "new"])
    docs = docs_of(spark, [" ".join(base), edited, " ".join(base).upper(), "  \n", words(80, 900)])
    rows = simhash.near_duplicates(docs).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert len(rows) == docs.count()
    assert got[0] == got[2] and got[3][0] == got[900][0] == 0 and got[900][1] == 3
    assert got[902][1] == 902 and got[None][1] is None
    apart = bin((got[0][0] ^ got[1][0]) & (2**64 - 1)).count("1")
    assert (got[1][1] == 0) == (apart <= 3)
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def spread(total, parts):
    if parts == 1:
        return [(total,)]
    return [(k, *rest) for k in range(total + 1) for rest in spread(total - k, parts - 1)]


def test_any_three_errors_leave_a_shared_key():
    """All ways in which up to three errors fall on the segments, at random places of random fingerprints."""
    table, rng = simhash.golay_table(), np.random.default_rng(5)
    left, right = [], []
    for errors in [e for n in (1, 2, 3) for e in spread(n, 3)]:
        for _ in range(400):
            x = y = int(rng.integers(0, 1 << 64, dtype=np.uint64))
            for (at, size), n in zip(simhash.SEGMENTS_64, errors):
                for b in rng.choice(size, n, replace=False):
                    y ^= 1 << (at + int(b))
            left.append(x)
            right.append(y)
    found = []
    for prints in (left, right):
        keys, at = simhash.keys_of(np.array(prints, np.uint64).view(np.int64), table)
        own = [set() for _ in prints]
        for k, i in zip(keys.tolist(), at.tolist()):
            own[i].add(k)
        found.append(own)
    assert all(a & b for a, b in zip(*found))


def plain_fingerprint(text, n=3):
    """The contract's fingerprint, bit by bit."""
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i:i + n]) for i in range(len(found) - n + 1)] if len(found) >= n else [" ".join(found)] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_classes_against_counting(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"Wort{n}É" for n in range(40)] + ["a\x1cb", "x\x0by", "\u2003", "\u0130"]
    base = [" ".join(rng.choice(vocabulary, rng.integers(1, 400))) for _ in range(30)]
    texts = base + [" ".join([*t.split(" ")[:-1], "other"]) for t in base] + ["long " * 100_000, "long " * 100_001]
    docs = docs_of(spark, texts)
    rows = simhash.near_duplicates(docs).collect()
    every = [(r.doc_id, r.text) for r in docs.collect()]
    want = {(d, plain_fingerprint(t) - (1 << 64) * (plain_fingerprint(t) >> 63)) for d, t in every}
    assert {(r.doc_id, r.fingerprint) for r in rows} == want and len(rows) == len(every)
    order = sorted(want, key=lambda w: (w[0] is None, w[0] or 0))
    part = classes(len(order), lambda i, j: bin((order[i][1] ^ order[j][1]) & (2**64 - 1)).count("1") <= 3)
    assert {(r.doc_id, r.component_id) for r in rows} == {(order[i][0], order[p][0]) for i, p in enumerate(part)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(order[p][0]) for p in part})
    assert simhash.keep_one(spark.createDataFrame([], DOCS)).count() == 0


def test_of_one_id_with_two_texts_each_class_keeps_its_own(spark):
    docs = spark.createDataFrame([(5, words(50)), (5, words(50, 900)), (3, words(50)), (5, words(50, 900))], DOCS.split(", __id")[0])
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == [(3, words(50)), (5, words(50, 900))]


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit([(6, "a"), (5, "b"), (4, "c"), (3, "d")], 10) == {"a": 0, "b": 1, "c": 0, "d": 1}
    tree, rng, keys = sharding.FitTree(), np.random.default_rng(1), set()
    for n in range(400):
        key = (int(rng.integers(0, 50)), n)
        tree.insert(key)
        keys.add(key)
        if n % 3 == 0:
            gone = sorted(keys)[int(rng.integers(0, len(keys)))]
            tree.remove(gone)
            keys.remove(gone)
        size = int(rng.integers(0, 55))
        assert tree.tightest(size) == min((k for k in keys if k[0] >= size), default=None)


def test_shards_are_even_and_keep_groups(spark):
    texts = [words(5 + k % 40, k) for k in range(3000)] + [words(12)] * 900
    docs = docs_of(spark, texts)
    rows = sharding.shard(docs, 8).toPandas()
    assert len(rows) == docs.count()
    size = rows.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() <= 1.02 * size.min()
    assert all(sorted(g) == list(range(len(g))) for _, g in rows.groupby("shard")["slot"])
    plain = rows[rows.doc_id.between(0, 2999)]
    assert plain.groupby(["text_crc32", "size"])["shard"].nunique().max() == 1
    assert rows[rows.doc_id == 900]["size"].tolist() == [words(5 + 900 % 40, 900).encode().__len__() + 8, 8]
    assert sharding.shard(spark.createDataFrame([], DOCS), 8).count() == 0
