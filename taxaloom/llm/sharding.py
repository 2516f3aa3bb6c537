"""Documents into shards of equal size by best-fit-decreasing bin packing.

Groups of equal texts are not divided. Groups that are large against a shard
are packed one by one; all others are dealt by hash into a fixed number of
bundles, which are packed like groups. So the packing sees a number of items
that depends on the number of shards only, whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from taxaloom.llm.common import whole_text
from taxaloom.session import cut

FINE = 512      # a group is packed by itself from this part of a shard on
PIECES = 64     # pieces of a group that is too large for a shard


class FitTree:
    """Bins by remaining capacity in an AA tree: insert, remove, tightest fit."""

    def __init__(self):
        self.root = None

    def insert(self, key):
        self.root = self._insert(self.root, key)

    def remove(self, key):
        self.root = self._remove(self.root, key)

    def tightest(self, size):
        """The least key whose capacity is ``size`` or more."""
        node, found = self.root, None
        while node:
            if node[0][0] >= size:
                found, node = node[0], node[2]
            else:
                node = node[3]
        return found

    # A node is [key, level, left, right].
    def _skew(self, n):
        if n and n[2] and n[2][1] == n[1]:
            left = n[2]
            n[2], left[3] = left[3], n
            return left
        return n

    def _split(self, n):
        if n and n[3] and n[3][3] and n[3][3][1] == n[1]:
            right = n[3]
            n[3], right[2] = right[2], n
            right[1] += 1
            return right
        return n

    def _insert(self, n, key):
        if not n:
            return [key, 1, None, None]
        side = 2 if key < n[0] else 3
        n[side] = self._insert(n[side], key)
        return self._split(self._skew(n))

    def _remove(self, n, key):
        if not n:
            return None
        if key != n[0]:
            side = 2 if key < n[0] else 3
            n[side] = self._remove(n[side], key)
        elif not n[2] and not n[3]:
            return None
        else:
            side = 2 if n[2] else 3
            near = n[side]
            while near[5 - side]:
                near = near[5 - side]
            n[0] = near[0]
            n[side] = self._remove(n[side], near[0])
        level = 1 + min(n[2][1] if n[2] else 0, n[3][1] if n[3] else 0)
        if level < n[1]:
            n[1] = level
            if n[3] and n[3][1] > level:
                n[3][1] = level
        n = self._skew(n)
        n[3] = self._skew(n[3])
        if n[3]:
            n[3][3] = self._skew(n[3][3])
        n = self._split(n)
        n[3] = self._split(n[3])
        return n


def best_fit(sizes: list[tuple[int, object]], capacity: int) -> dict[object, int]:
    """Bin of each (size, item), sizes descending, in the tightest open bin that has room."""
    open_bins, bins, where = FitTree(), 0, {}
    for size, item in sizes:
        fit = open_bins.tightest(size)
        if fit is None:
            fit = (capacity, bins)
            bins += 1
        else:
            open_bins.remove(fit)
        where[item] = fit[1]
        open_bins.insert((fit[0] - size, fit[1]))
    return where


def pack(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """The packing of least capacity (to a ten-thousandth) found that needs ``shards`` bins at most."""
    sizes = sorted(sizes, key=lambda x: (-x[0], str(x[1])))
    low = max([-(-sum(s for s, _ in sizes) // shards), *(s for s, _ in sizes[:1])], default=0)
    high, best = low + max([s for s, _ in sizes[:1]], default=0), None
    while best is None or high - low > low // 10_000:
        capacity = (low + high) // 2 if best is not None else high
        found = best_fit(sizes, capacity)
        if max(found.values(), default=0) < shards:
            best, high = found, min(high, capacity)
        elif best is None:
            high *= 2
        else:
            low = capacity + 1
    return best


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of ``docs``.

    ``size`` is the text's UTF-8 bytes (null: none) plus ``overhead``. Shards
    hold nearly equal bytes; rows of equal text share a shard, unless a group
    is larger than an equal share: it cannot stay whole then and is cut into
    pieces. Null and empty texts are one group. ``slot`` numbers the rows of a
    shard from 0 without gaps. Repeated rows are rows of their own; an empty
    table gives no rows; fewer groups than shards leave shards empty.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    rows = cut(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),  # stored here, so it is the same wherever it is read
    ))
    groups = cut(rows.groupBy("text_hash", "size").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    share = total / shards
    bundles = shards * FINE
    piece = F.pmod(F.xxhash64("doc_id", "row"), F.lit(PIECES))
    # A group is one unit from 1/FINE of a share on; beyond a share its pieces are.
    named = groups.select(
        "text_hash", "size",
        F.when(F.col("bytes") > share, 2).when(F.col("bytes") * FINE >= share, 1).otherwise(0).alias("kind"),
        "bytes",
    )
    bundle = F.pmod(F.xxhash64("text_hash", "size"), F.lit(bundles)).cast("string")
    unit = F.concat_ws("/", "text_hash", "size")
    large = named.filter("kind > 0").select("text_hash", "size", "kind")
    # At most shards * FINE groups reach 1/FINE of a share: a bound that does not grow with the data.
    placed = rows.join(F.broadcast(large), ["text_hash", "size"], "left").select(
        "doc_id", "size", "text_crc32",
        F.when(F.col("kind") == 2, F.concat_ws("/", unit, piece)).when(F.col("kind") == 1, unit)
        .otherwise(bundle).alias("unit"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(PIECES)).alias("salt"),
    )
    sizes = placed.groupBy("unit").agg(F.sum("size").alias("bytes")).collect()  # bounded, see above
    where = pack([(r.bytes, r.unit) for r in sizes], shards)
    places = spark.createDataFrame(sorted(where.items()), "unit string, shard int")
    placed = cut(placed.join(F.broadcast(places), "unit"))
    counts = placed.groupBy("shard", "unit", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("unit", "salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "unit", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "unit", "salt").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("at", F.row_number().over(order) - 1)
    return numbered.join(first, ["shard", "unit", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).alias("slot")
    )
