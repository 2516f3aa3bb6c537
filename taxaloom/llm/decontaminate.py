"""Benchmark passages in documents, found by spaced seeds and verified word by word.

A seed is a pattern of word positions; the words at these positions are hashed,
those between are ignored. So a passage is met although words of it were
replaced. Around a hit, document and item are held against each other word by
word, and a window of ``WINDOW`` words must agree in ``AGREE`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.common import row_key, unused, whole_text

#: Positions of the words that count. All seeds begin with two words next to each other.
#: Whichever words of a window may differ, a seed fits among the others; so it is in items of SEEDED words or more.
SEEDS = ((0, 1, 3, 4, 7, 8), (0, 1, 2, 5, 7, 9), (0, 1, 4, 5, 6, 9), (0, 1, 6, 7, 8, 9))
SEEDED = 11
WINDOW, AGREE = 13, 11
BLOCK_WORDS = 1 << 20   # words of benchmark items that are sent to all tasks at a time


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


SHORTEST = min(max(seed) for seed in SEEDS) + 1   # words that the shortest seed spans


def places_of(words: str) -> Column:
    """array<struct<start, hashes, at>> for each position (from 0) at which a seed fits.

    ``start`` is a hash of the two words there, which all seeds begin with;
    ``hashes`` holds one per seed of its other words, null where the seed does not fit. So rows
    made from it carry a few numbers and not the text.
    """
    seen = lambda at, seed: F.xxhash64(*[F.get(words, at + p) for p in seed])

    def place(at: Column) -> Column:
        fits = [F.when(at + max(seed) < F.size(words), seen(at, seed[2:])) for seed in SEEDS]
        return F.struct(seen(at, (0, 1)).alias("start"), F.array(*fits).alias("hashes"), at.alias("at"))

    every = F.sequence(F.lit(0), F.greatest(F.size(words) - SHORTEST, F.lit(0)))
    return F.transform(every, place)


def short_seeds(n: int) -> list[tuple[int, ...]]:
    """Seeds for items of ``n`` words: all words if none may differ, else all but two next to each other."""
    if n * (WINDOW - AGREE) < WINDOW:
        return [tuple(range(n))]
    return [tuple(i for i in range(n) if i // 2 != k) for k in range(-(-n // 2))]


def item_blocks(benchmark: DataFrame) -> tuple[list[DataFrame], list[int]]:
    """(item_id, item) in blocks of bounded size, so that each can be sent to all tasks; sizes of items below SEEDED."""
    items = benchmark.select("item_id", words_of(whole_text()).alias("item")).distinct()
    size = F.size("item")
    short = F.when((size > 0) & (size < SEEDED), size)
    total, sizes = items.agg(F.sum(size), F.sort_array(F.collect_set(short))).first()
    n = -(-(total or 0) // BLOCK_WORDS) or 1
    if n == 1:
        return [items], sizes
    block = F.pmod(F.xxhash64("item_id", "item"), F.lit(n))
    return [items.filter(block == k) for k in range(n)], sizes


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, body, item_id, window_words, matched_words) of documents that hold a passage of an item.

    ``matched_words``: the most words that agree in an aligned window of
    ``WINDOW`` words (of an item with fewer, all of them); pairs with fewer
    than ``AGREE`` (of 13; shorter items in proportion) are left out. Case and
    punctuation do not count. All such pairs are found. Items without words
    match nothing. Null and empty texts hold nothing; repeated rows count once.
    """
    rows = docs.select(*row_key(id_col, text_col), whole_text(text_col).alias("text"))
    found = None
    blocks, sizes = item_blocks(benchmark)
    for items in blocks:
        part = _overlaps(rows, items, sizes)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("id", "body", "item_id").agg(
        F.max("window_words").alias("window_words"), F.max("matched_words").alias("matched_words")
    )


def _seeded(rows: DataFrame, words: str, by: list[str]) -> DataFrame:
    placed = rows.filter(F.size(words) >= SHORTEST).select(*by, F.explode(places_of(words)).alias("p"))
    return placed.select(*by, "p.start", "p.hashes", "p.at")


def _short_hits(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, body, item_id, shift) of items of fewer than SEEDED words; where no word may differ, the first alone."""
    def seen(words: str, at: Column, n: int, k: int, seed: tuple[int, ...]) -> Column:
        found = F.xxhash64(F.lit(n), F.lit(k), *[F.get(words, at + (p - seed[0])) for p in seed])
        return F.when(at + (seed[-1] - seed[0]) < F.size(words), F.struct(found.alias("hash"), (at - seed[0]).alias("shift")))

    seeds = [(n, k, seed) for n in sizes for k, seed in enumerate(short_seeds(n))]
    of_item = F.array(*[F.when(F.size("item") == n, seen("item", F.lit(seed[0]), n, k, seed)) for n, k, seed in seeds])
    at_word = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1), lambda at: F.array(*[seen("words", at, n, k, seed) for n, k, seed in seeds])
    )
    keys = items.select("item_id", F.size("item").alias("n"), F.explode(F.array_compact(of_item)).alias("s")).select("item_id", "n", "s.hash")
    worded = rows.select("id", "body", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    met = worded.select("id", "body", F.explode(at_word).alias("at")).select("id", "body", F.explode(F.array_compact("at")).alias("s"))
    met = met.select("id", "body", "s.hash", "s.shift").join(F.broadcast(keys), "hash")
    one = F.when(F.col("n") * (WINDOW - AGREE) >= WINDOW, F.col("shift"))
    return met.groupBy("id", "body", "item_id", "n", one.alias("one")).agg(F.min("shift").alias("shift")).select("id", "body", "item_id", "shift")


def _overlaps(rows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    places = _seeded(items, "item", ["item_id", "item"])
    starts = places.select("start").distinct()
    seeds = places.select("item_id", "start", F.col("at").alias("place"), F.posexplode("hashes").alias("seed", "hash")).filter("hash IS NOT NULL")
    at = _seeded(rows.select("id", "body", words_of(F.col("text")).alias("words")), "words", ["id", "body"])
    # What is sent to all tasks holds at most BLOCK_WORDS rows, times the number of seeds.
    likely = at.join(F.broadcast(starts), "start", "left_semi")
    likely = likely.select("id", "body", "at", "start", F.posexplode("hashes").alias("seed", "hash"))
    hits = likely.join(F.broadcast(seeds), ["seed", "start", "hash"]).select("id", "body", "item_id", (F.col("at") - F.col("place")).alias("shift"))
    if sizes:
        hits = hits.unionByName(_short_hits(rows, items, sizes))
    hits = (
        hits.select("id", "body", F.struct("item_id", "shift").alias("hit"))
        .groupBy("id", "body").agg(F.collect_set("hit").alias("hits"))
        .select(F.col("id").alias("in_id"), F.col("body").alias("in_body"), "hits")
    )
    # Only the texts of documents with hits are looked at again.
    met = rows.join(hits, F.col("id").eqNullSafe(F.col("in_id")) & (F.col("body") == F.col("in_body")))
    met = met.select("id", "body", words_of(F.col("text")).alias("words"), "hits")
    met = met.select("id", "body", "words", F.explode("hits").alias("h")).select("id", "body", "words", "h.item_id", "h.shift")
    met = met.join(F.broadcast(items.withColumnRenamed("item_id", "of")), F.col("item_id").eqNullSafe(F.col("of")))
    shift = F.col("shift")
    agree = F.transform(
        "item", lambda w, i: F.coalesce((F.when(i + shift >= 0, F.get("words", i + shift)) == w).cast("int"), F.lit(0))
    )
    checked = met.select("id", "body", "item_id", F.least(F.size("item"), F.lit(WINDOW)).alias("window_words"), agree.alias("agree"))
    most = F.array_max(F.transform(
        F.sequence(F.lit(1), F.size("agree") - F.col("window_words") + 1),
        lambda s: F.aggregate(F.slice("agree", s, F.col("window_words")), F.lit(0), lambda a, x: a + x),
    ))
    return (
        checked.withColumn("matched_words", most)
        .filter(F.col("matched_words") * WINDOW >= F.col("window_words") * AGREE)
        .select("id", "body", "item_id", "window_words", "matched_words")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`overlaps` finds; columns stay as they are."""
    key, body, of, of_body = unused(docs, "key", "body", "of", "of_body")
    bad = overlaps(docs, benchmark, id_col, text_col).select(F.col("id").alias(of), F.col("body").alias(of_body)).distinct()
    met = docs.select("*", *[c.alias(n) for c, n in zip(row_key(id_col, text_col), (key, body))])
    left = met.join(bad, F.col(key).eqNullSafe(F.col(of)) & (F.col(body) == F.col(of_body)), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
