"""Near-duplicates by SimHash fingerprints that meet on Golay codewords.

Every word of 23 bits is within three bits of exactly one codeword of the
binary Golay code. The codewords nearest to a word and to its neighbours at one
bit are six at most (one, if the word is within two bits of its codeword). Two
words that differ in one bit share the codeword of either; words that differ in
two bits share the codeword of a word between them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations, permutations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.common import by_batch, kept, row_key, unused, whole_text
from taxaloom.llm.graph import components
from taxaloom.session import cut

SEED = 42
BLOCK = 1 << 16          # words hashed at a time
GOLAY = 0b101011100011   # generator polynomial of the Golay code
SEGMENTS_64 = ((0, 23), (23, 23), (46, 18))
HALF = 9                 # bits of each half of the last segment


def shingle_hashes(words: list[bytes], n: int, start: int = 0, end: int | None = None) -> np.ndarray:
    """XXH64 of the shingles that begin at words ``start`` to ``end``; short texts are one shingle."""
    import xxhash

    if len(words) < n:
        shingles = [b" ".join(words)] if words else []
    else:
        end = len(words) - n + 1 if end is None else min(end, len(words) - n + 1)
        part = words[start:end + n - 1]
        shingles = list(map(b" ".join, zip(*(part[i:] for i in range(n)))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def fingerprint_of(words: list[bytes], n: int) -> int:
    """64 bits, each 1 if set in over half of the shingles' hashes."""
    total, count = np.zeros(64, np.int64), 0
    for start in range(0, max(1, len(words) - n + 1), BLOCK):
        hashes = shingle_hashes(words, n, start, start + BLOCK)
        total += np.unpackbits(hashes.astype("<u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
        count += len(hashes)
    return int(np.packbits(total * 2 > count).view("<u8")[0])


def fingerprints(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, body, fingerprint) per row: a hash of the text and the fingerprint, both as signed longs.

    Null and empty texts, and those of white space, have fingerprint 0; a null
    id stays null. Any number of columns is allowed, others are not read.
    """

    def build() -> Callable:
        def step(rows: dict[str, list]) -> dict[str, list]:
            prints = [fingerprint_of(words_of(t), words) for t in rows["text"]]
            return {
                "doc_id": rows["doc_id"], "body": rows["body"],
                "fingerprint": np.array(prints, np.uint64).astype(np.int64),
            }

        return step

    key, body = row_key(id_col, text_col)
    rows = docs.select(key.cast("long").alias("doc_id"), body, whole_text(text_col).alias("text"))
    return by_batch(rows, build, "doc_id long, body long, fingerprint long")


def golay_table() -> np.ndarray:
    """For each of the 2^23 words, the number (12 bits) of its codeword; made once per worker."""
    return kept("golay", GOLAY, _golay_table)


def _golay_table() -> np.ndarray:
    codes = np.zeros(1, np.int64)
    for i in range(12):
        codes = np.concatenate([codes, codes ^ (GOLAY << i)])
    errors = [0] + [sum(1 << b for b in c) for k in (1, 2, 3) for c in combinations(range(23), k)]
    nearest, numbers = np.empty(1 << 23, np.int16), np.arange(4096, dtype=np.int16)
    for error in errors:
        nearest[codes ^ error] = numbers
    return nearest


def near_codewords(table: np.ndarray, segment: np.ndarray, bits: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """The own codeword of each word, and those near it: sorted, with -1 for repeats."""
    flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    near = np.sort(table[segment[:, None] ^ flips[None, :]].astype(np.int64), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return table[segment].astype(np.int64), near


def segment_keys(prints: DataFrame) -> DataFrame:
    """(key, id): keys that two fingerprints with at most three differing bits share; see :func:`keys_of`."""

    def build() -> Callable:
        table = golay_table()

        def step(rows: dict[str, list]) -> dict[str, list]:
            prints = np.array(rows["fingerprint"], np.int64)
            keys, at = keys_of(prints, table)
            return {"key": keys, "id": prints[at]}

        return step

    return by_batch(prints.select("fingerprint"), build, "key long, id long")


def keys_of(prints: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, and the places of their fingerprints.

    Three errors fall on three segments in one of two ways. If a segment is
    free of them, another has one at most: a key holds the bits of the one and
    a codeword near the other (30 or 35 bits), for each ordered pair of
    segments. Else each segment has one, and a half of the short one has none:
    a key holds that half, the own codeword of one long segment and a near
    codeword of the other (33 bits). Whichever of two fingerprints gives the
    own codeword, the other has it among the near ones.
    """
    bits = [(prints >> at) & ((1 << size) - 1) for at, size in SEGMENTS_64]
    own, near = zip(*(near_codewords(table, word, size) for word, (_, size) in zip(bits, SEGMENTS_64)))
    keys = []
    for number, (i, j) in enumerate(permutations(range(3), 2)):
        keys.append(np.where(near[j] < 0, -1, (number << 23 | bits[i][:, None]) << 12 | near[j]))
    one = np.where(near[0] < 0, -1, near[0] << 12 | own[1][:, None])
    other = np.where((near[1] < 0) | (near[1] == own[1][:, None]), -1, own[0][:, None] << 12 | near[1])
    for number in range(2):
        half = bits[2] >> HALF * number & (1 << HALF) - 1
        for pair in (one, other):
            keys.append(np.where(pair < 0, -1, (6 + number << HALF | half[:, None]) << 24 | pair))
    found = np.concatenate(keys, axis=1)
    at, column = np.nonzero(found >= 0)
    return found[at, column], at


def bucket_links(keys: DataFrame, close: Callable[[Column, Column], Column]) -> DataFrame:
    """Links (a, b) that join all of ``id`` which share a ``key`` and are ``close``.

    Pairs are compared within the joins, so that only those that pass leave
    them. First all of a key are held against the least of it; then what the
    links found so far leave apart is held against the others of the key. So a
    large group of near copies gives as many pairs as rows, not their square,
    and its components are those that all pairs would give.
    """
    keys = cut(keys)
    near = close(F.col("a"), F.col("b"))
    least = keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    first = cut(
        keys.join(least, "key").withColumnRenamed("id", "b").filter("a <> b").filter(near).select("a", "b").distinct()
    )
    parts = components(first)
    shared = (
        keys.join(least.select("key"), "key", "left_semi")
        .join(parts, "id", "left")
        .select("key", "id", F.coalesce("component", "id").alias("part"))
    )
    sizes = shared.groupBy("key", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts"))
    split = cut(shared.join(main.filter("parts > 1").drop("parts"), "key"))
    rest = split.filter("part <> main").select("key", F.col("id").alias("a"), F.col("part").alias("part_a"))
    others = split.select("key", F.col("id").alias("b"), F.col("part").alias("part_b"), "main")
    pairs = (
        rest.join(others, "key").filter("part_a <> part_b AND (part_b = main OR a < b)").filter(near)
        .select("a", "b").distinct()
    )
    return first.union(pairs)


def fingerprint_links(prints: DataFrame, differing: int = 3) -> DataFrame:
    """Links between distinct fingerprints that differ in at most ``differing`` (0 to 3) bits."""
    if not 0 <= differing <= 3:
        raise ValueError("the keys guarantee three differing bits")
    return bucket_links(segment_keys(prints), lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= differing)


def near_duplicates(
    docs: DataFrame, words: int = 3, differing: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Fingerprints within ``differing`` bits link; ``component_id`` is the least
    id reachable over links. Equal fingerprints are one node, so copies never
    meet in pairs. Repeated rows stay; ids that are null take part but are no
    component's least id unless all of its ids are null. An empty table gives
    no rows.
    """
    classes, named = _classes(docs, words, differing, id_col, text_col)
    return classes.join(named, "fingerprint").select("doc_id", "fingerprint", F.col("first.doc_id").alias("component_id"))


def _classes(docs: DataFrame, words: int, differing: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of the rows, and (fingerprint, first): the first row of each one's class."""
    prints = cut(fingerprints(docs, words, id_col, text_col))
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "body")
    nodes = cut(prints.groupBy("fingerprint").agg(F.min(row).alias("first")))
    parts = components(fingerprint_links(nodes, differing))
    placed = cut(
        nodes.join(parts.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    )
    first = placed.groupBy("component").agg(F.min("first").alias("first"))
    return prints, cut(placed.select("fingerprint", "component").join(first, "component").select("fingerprint", "first"))


def keep_one(
    docs: DataFrame, words: int = 3, differing: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row of each class of :func:`near_duplicates`; columns stay as they are.

    Rows are ordered by id, null last, then by a hash of the text. A row given
    more than once stays once.
    """
    key, body, of, of_body = unused(docs, "key", "body", "of", "of_body")
    _, named = _classes(docs, words, differing, id_col, text_col)
    first = named.select(F.col("first.doc_id").alias(of), F.col("first.body").alias(of_body)).distinct()
    met = docs.select("*", *[c.alias(n) for c, n in zip(row_key(id_col, text_col), (key, body))])
    met = met.join(first, F.col(key).cast("long").eqNullSafe(F.col(of)) & (F.col(body) == F.col(of_body)), "left_semi")
    return met.dropDuplicates([key, body]).select(*[F.col(f"`{c}`") for c in docs.columns])
