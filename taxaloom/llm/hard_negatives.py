"""Hard negatives of anchor vectors by exact integer scores from Four-Russians tables.

Components are integers. For every eight dimensions of an anchor a table holds
the sums of all 256 subsets of its components. A candidate is cut into bit
planes; of each plane, the bits of eight dimensions are one byte, which picks
the sum of the anchor's components where the candidate has that bit. Summed
over the dimensions and shifted together plane by plane, the looked-up sums are
the whole inner product.

Anchors are a stated set of queries: they are taken in blocks of bounded size,
and each block is held against all rows, which are never shuffled. A task keeps
the first few rows of each anchor, so what it passes on does not depend on how
many rows it has seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.session import shared_folder

SCALE = 256        # a component is floor(SCALE * x)
BLOCK = 4096       # anchors sent to the tasks at a time; all blocks are taken
TILE = 256         # anchors of one set of tables
CHUNK = 512        # candidates scored at a time
LEAST = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale).astype(np.int64)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every byte the sum of the components whose bit is set in it."""
    n, dims = anchors.shape
    groups = max(1, -(-dims // 8))
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :dims] = anchors
    most = int(np.abs(padded).sum(axis=1).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    tables = np.zeros((groups, 256, n), kind)
    for g in range(groups):
        for bit in range(8):
            tables[g, 1 << bit:2 << bit] = tables[g, :1 << bit] + padded[:, 8 * g + bit].astype(kind)
    return tables


def bit_planes(candidates: np.ndarray, groups: int) -> np.ndarray:
    """(planes, groups, candidates): packed bits in two's complement, the plane of the signs first."""
    n, dims = candidates.shape
    most = max(int(candidates.max(initial=0)), -int(candidates.min(initial=0)) - 1)
    planes = most.bit_length() + 1
    out = np.zeros((planes, groups, n), np.uint8)
    for k, shift in enumerate(range(planes - 1, -1, -1)):
        bits = np.zeros((n, groups * 8), np.uint8)
        bits[:, :dims] = (candidates >> shift) & 1
        out[k] = np.packbits(bits.reshape(n, groups, 8), axis=2, bitorder="little")[:, :, 0].T
    return out


def inner_products(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): the exact scores, by lookups, shifts and additions."""
    total = None
    for k, plane in enumerate(planes):
        summed = tables[0][plane[0]]
        for g in range(1, len(plane)):
            summed += tables[g][plane[g]]
        if total is None:
            total = -summed.astype(np.int64)
        else:
            total <<= 1
            total += summed
    return total


class FirstRows:
    """The first ``k`` rows of each anchor: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.scores = np.full((anchors, k), LEAST)
        self.ids = np.full((anchors, k), LAST)
        self.filled = np.zeros(anchors, np.int64)

    def worst(self) -> np.ndarray:
        """A score below it is not among the first ``k``."""
        return self.scores[:, -1]

    def add(self, scores: np.ndarray, good: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` and whether they count, (candidates, anchors), and the candidates' ids."""
        good = good & (scores >= self.worst())
        if np.count_nonzero(good) > 4 * self.scores.size and len(ids) > self.k:
            # Many count: those below the k-th of this chunk cannot stay.
            shown = np.where(good, scores, LEAST)
            good &= scores >= np.partition(shown, len(ids) - self.k, axis=0)[len(ids) - self.k]
        row, anchor = np.nonzero(good)
        if not len(row):
            return
        old = np.arange(self.k) < self.filled[:, None]
        touched = np.zeros(len(old), bool)
        touched[anchor] = True
        old &= touched[:, None]
        old_anchor, place = np.nonzero(old)
        anchor = np.concatenate([anchor, old_anchor])
        score = np.concatenate([scores[row, anchor[:len(row)]], self.scores[old_anchor, place]])
        ids = np.concatenate([ids[row], self.ids[old_anchor, place]])
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        begins = np.searchsorted(anchor, anchor, side="left")
        place = np.arange(len(anchor)) - begins
        first = place < self.k
        anchor, place = anchor[first], place[first]
        self.scores[anchor, place], self.ids[anchor, place] = score[first], ids[first]
        self.filled[touched] = np.bincount(anchor, minlength=len(touched))[touched]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors, ids and scores of all that is kept."""
        anchor, place = np.nonzero(np.arange(self.k) < self.filled[:, None])
        return anchor, self.ids[anchor, place], self.scores[anchor, place]


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & sound
    ).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The first ``dims`` components of each vector; what a shorter one lacks counts as zero."""
    values, sizes = column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy()
    if (sizes == dims).all():
        return quantised(values.reshape(-1, dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), dims), np.int64)
    out[row[place < dims], place[place < dims]] = quantised(values[place < dims])
    return out


def _scored(
    rows: DataFrame, block: dict, keep: Callable[[], tuple[Callable, Callable]], schema: str
) -> DataFrame:
    """Scores of all rows against a block of anchors, tile by tile.

    ``keep()`` gives two functions: one takes a tile's place, the scores, ids
    and labels of candidates; the other gives a task's result.
    """
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, labels, wanted = sent.value["vectors"], sent.value["labels"], sent.value["labels_of_tile"]
        tables = [subset_sums(anchors[at:at + TILE]) for at in range(0, len(anchors), TILE)]
        add, result = keep()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids, found = (part.column(c).to_numpy() for c in (0, 1))
                planes = bit_planes(_matrix(part.column(2), anchors.shape[1]), tables[0].shape[0])
                for tile, table in enumerate(tables):
                    # Only candidates whose label some anchor of the tile can use are scored.
                    of_tile = labels[TILE * tile:TILE * (tile + 1)]
                    usable = np.isin(found, of_tile) if wanted == "same" else (
                        found != of_tile[0] if (of_tile == of_tile[0]).all() else np.ones(len(found), bool))
                    if usable.any():
                        scores = inner_products(table, planes[:, :, usable])
                        add(tile, scores, ids[usable], found[usable])
        yield pa.RecordBatch.from_pydict(result(), schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return rows.mapInArrow(run, schema)


def positives_of(rows: DataFrame, block: dict, k: int) -> DataFrame:
    """(anchor, id, score): the first ``k`` other rows of each anchor's label; ``anchor`` is a place in the block."""
    own, labels = block["ids"], block["labels"]

    def keep() -> tuple[Callable, Callable]:
        tiles = [FirstRows(len(own[at:at + TILE]), k) for at in range(0, len(own), TILE)]

        def add(tile: int, scores: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
            here = slice(TILE * tile, TILE * (tile + 1))
            tiles[tile].add(scores, (found[:, None] == labels[here]) & (ids[:, None] != own[here]), ids)

        def result() -> dict:
            parts = [(anchor + TILE * n, ids, scores) for n, t in enumerate(tiles) for anchor, ids, scores in [t.rows()]]
            return dict(zip(("anchor", "id", "score"), map(np.concatenate, zip(*parts))))

        return add, result

    found = _scored(rows, block | {"labels_of_tile": "same"}, keep, "anchor long, id long, score long")
    return _first(found, ["anchor"], k)


def negatives_of(
    rows: DataFrame, block: dict, lowest: np.ndarray, highest: np.ndarray, k: int
) -> DataFrame:
    """(anchor, positive, id, score): per anchor and positive the first ``k`` rows of other labels within its bounds.

    The bounds are (anchors, positives) and inclusive; where there is no
    positive the lower one is above the upper one.
    """
    labels = block["labels"]
    positives = lowest.shape[1]

    def keep() -> tuple[Callable, Callable]:
        tiles = [[FirstRows(len(labels[at:at + TILE]), k) for _ in range(positives)] for at in range(0, len(labels), TILE)]

        def add(tile: int, scores: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
            here = slice(TILE * tile, TILE * (tile + 1))
            other = found[:, None] != labels[here]
            for p, first in enumerate(tiles[tile]):
                within = (scores >= np.maximum(lowest[here, p], first.worst())) & (scores <= highest[here, p])
                first.add(scores, other & within, ids)

        def result() -> dict:
            parts = [
                (anchor + TILE * n, np.full(len(ids), p), ids, scores)
                for n, t in enumerate(tiles) for p, first in enumerate(t) for anchor, ids, scores in [first.rows()]
            ]
            return dict(zip(("anchor", "positive", "id", "score"), map(np.concatenate, zip(*parts))))

        return add, result

    found = _scored(
        rows, block | {"labels_of_tile": "other"}, keep, "anchor long, positive long, id long, score long"
    )
    return _first(found, ["anchor", "positive"], k)


def _first(found: DataFrame, groups: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group, numbered from 1; a task gave that many at most."""
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are ``floor(256 * x)``, a score is the integer inner product
    with the anchor; higher scores come first, of equal ones the smaller id.
    ``is_anchor`` chooses the anchors by columns ``id`` and ``label``. An
    anchor's positives are its first ``positives`` other rows of its label.
    For each, the first ``negatives`` rows of other labels are given whose
    score is between ``low`` and ``high`` hundredths of the positive's.

    Rows with a null id, label or vector, or a null or non-finite component
    take no part. Of vectors of unlike lengths, what the shorter one lacks
    counts as zero. A row given twice is two rows, and neither is another row
    to an anchor of that id; an anchor given twice is one anchor, and two
    anchors of one id that differ are two. Scores must fit a long. No anchors,
    positives or negatives: no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = whole_rows(vectors, id_col, vector_col, label_col)
    anchors = rows.filter(is_anchor).dropDuplicates()
    blocks = -(-anchors.count() // BLOCK)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    path = f"{shared_folder(spark)}/mined-{uuid.uuid4().hex}"
    for number in range(blocks):
        # A hash deals anchors out evenly, so a block is BLOCK rows or a few more.
        dealt = anchors.filter(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == number)
        taken = sorted((r.label, r.id, list(r.vector)) for r in dealt.collect())
        if not taken:
            continue
        dims = max(1, *(len(v) for _, _, v in taken))
        block = {
            "ids": np.array([i for _, i, _ in taken], np.int64),
            "labels": np.array([label for label, _, _ in taken], np.int64),
            "vectors": quantised(np.array([v + [0.0] * (dims - len(v)) for _, _, v in taken])),
        }
        found = positives_of(rows, block, positives).collect()  # BLOCK * positives rows
        scores = np.zeros((len(taken), positives), np.int64)
        named = np.zeros((len(taken), positives), np.int64)
        lowest, highest = np.ones_like(scores), np.zeros_like(scores)
        for r in found:
            at = r.anchor, r["rank"] - 1
            named[at], scores[at] = r.id, r.score
            lowest[at], highest[at] = -(-low * r.score // 100), high * r.score // 100
        about = spark.createDataFrame(
            [(r.anchor, r["rank"] - 1, int(block["ids"][r.anchor]), r.id, r.score) for r in found],
            "anchor long, positive long, anchor_id long, positive_id long, positive_score long",
        )
        mined = negatives_of(rows, block, lowest, highest, negatives)
        mined.join(F.broadcast(about), ["anchor", "positive"]).select(  # BLOCK * positives rows
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.parquet(f"{path}/{number}")
    return spark.read.schema(RESULT).option("recursiveFileLookup", "true").parquet(path)
