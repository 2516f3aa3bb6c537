"""Flat token files, and the tokens of each document in them by a separator scan.

A file is nothing but token ids of fixed width; a document ends with the
end-of-document id. Blocks of a file are searched alone; where a document began
that ends in a block follows from a running maximum over the blocks before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from taxaloom.llm import bpe
from taxaloom.llm.common import by_batch, whole_text

BLOCK = 1 << 20        # tokens searched at a time
FILE_BYTES = 32 << 20   # a file is closed once it holds so many, so that it fits in one row
BASE, DIGITS = 50_000, 5  # a document's id as tokens below any special one


def id_digits(doc_id: int | None) -> list[int]:
    """An id, negative or null too, as ``DIGITS`` tokens."""
    n = 0 if doc_id is None else 2 * doc_id + 1 if doc_id >= 0 else -2 * doc_id
    return [n // BASE**k % BASE for k in range(DIGITS)]


def id_of(digits: list[int]) -> int | None:
    n = sum(int(d) * BASE**k for k, d in enumerate(digits))
    return None if n == 0 else n // 2 if n % 2 else -(n // 2)


def packed(doc_id: int | None, ids: bytes | None, eod: int) -> bytes:
    """A document as it stands in a file, without ``eod``: its id's digits and its tokens."""
    body = np.frombuffer(ids or b"", "<u4")
    if len(body) and (body.max() >= 1 << 16 or (body == eod).any()):
        raise ValueError(f"document {doc_id} has tokens that a flat file cannot hold")
    return np.array(id_digits(doc_id), "<u2").tobytes() + body.astype("<u2").tobytes()


def write_token_files(tokens: DataFrame, path: str, eod: int) -> None:
    """Write (doc_id, ids) as flat files of unsigned 16-bit tokens below ``path``.

    Each document is its id as ``DIGITS`` tokens, its tokens, and ``eod``.
    Tokens must be below 2^16 and differ from ``eod``; null ids are an empty list.
    """

    def build() -> Callable:
        return _filled(eod, lambda rows: zip(rows["doc_id"], rows["ids"]))

    _write(by_batch(tokens.select("doc_id", "ids"), build, "flat binary", flush=True), path, eod)


def write_text_files(
    docs: DataFrame, path: str, eod: int, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """The files of :func:`write_token_files` for the tokens of whole texts, without special tokens.

    Texts are encoded and packed by one worker per task. Null texts have no
    tokens, null ids and repeated rows stay; other columns are not read.
    """
    file = bpe.read_vocabulary(docs, vocabulary)

    def build() -> Callable:
        encoder = bpe.encoder_of(file.value, False)

        return _filled(eod, lambda rows: zip(rows["doc_id"], encoder.texts(rows["text"])))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    _write(by_batch(rows, build, "flat binary", flush=True), path, eod)


def _filled(eod: int, documents: Callable[[dict[str, list]], Iterable[tuple]]) -> Callable:
    """A step that gives files as rows; documents within a file are parted by ``eod``, the last is left open."""
    held: list[bytes] = []
    size, between = 0, eod.to_bytes(2, "little")

    def step(rows: dict[str, list] | None) -> dict[str, list]:
        nonlocal size
        files = []
        for doc_id, ids in documents(rows) if rows else ():
            held.append(packed(doc_id, ids, eod))
            size += len(held[-1])
            if size >= FILE_BYTES:
                files.append(between.join(held))
                held.clear()
                size = 0
        if rows is None and held:
            files.append(between.join(held))
        return {"flat": files}

    return step


def _write(flat: DataFrame, path: str, eod: int) -> None:
    """Files by Spark's text writer, whose line separator is ``eod``, so any store that Spark writes to will do."""
    (
        flat.select(F.col("flat").cast("string").alias("value"))
        .write.option("lineSep", eod.to_bytes(2, "little").decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


BLOCKS = "path string, block long, n_tokens long, ends array<long>, heads array<array<int>>"


def scan_blocks(spark: SparkSession, path: str, eod: int, head: int = 0, block: int = BLOCK) -> DataFrame:
    """Per block of the files below ``path``: where its separators are.

    ``ends`` are their places in the file; ``heads`` hold the first ``head``
    tokens of every document that begins in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                flat = np.frombuffer(content.as_buffer(), "<u2")
                for number, start in enumerate(range(0, len(flat), block)):
                    ends = start + np.flatnonzero(flat[start:start + block] == eod)
                    begins = np.concatenate([[0] if start == 0 else [], ends + 1]).astype(np.int64)
                    row = {
                        "path": name, "block": number, "n_tokens": len(flat[start:start + block]),
                        "ends": ends.tolist(), "heads": [flat[b:b + head].tolist() for b in begins],
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema([
        ("path", pa.string()), ("block", pa.int64()), ("n_tokens", pa.int64()),
        ("ends", pa.list_(pa.int64())), ("heads", pa.list_(pa.list_(pa.int32()))),
    ])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter("length > 0").select("path", "content").mapInArrow(run, BLOCKS)


def stitch(blocks: DataFrame) -> DataFrame:
    """(path, document, start, n_tokens, head, complete) from the blocks of :func:`scan_blocks`.

    A prefix scan over the blocks of a file carries the number of documents
    ended before a block, the place after the last separator, and the head of
    the document open there. Blocks are few and small rows. What follows the
    last separator of a file is a document too, marked as not ``complete``;
    empty documents have no tokens.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("path")
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1)
    begun = F.when(F.size("heads") > 0, F.element_at("heads", -1))
    carried = blocks.select(
        "path", "block", "ends", "heads",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ended"),
        F.coalesce(F.max(last).over(before), F.lit(0)).alias("open_from"),
        F.coalesce(F.last(begun, True).over(before), F.element_at("heads", 1)).alias("open_head"),
        F.sum("n_tokens").over(file).alias("length"),
        F.max("block").over(file).alias("last_block"),
    )
    own = F.when(F.col("block") == 0, F.expr("slice(heads, 2, size(heads))")).otherwise(F.col("heads"))
    listed = carried.select(
        "path", "ended",
        F.when(F.col("block") == F.col("last_block"), F.concat("ends", F.array("length")))
        .otherwise(F.col("ends")).alias("ends"),
        F.size("ends").alias("closed"),
        F.concat(F.array("open_from"), F.transform("ends", lambda e: e + 1)).alias("starts"),
        F.concat(F.array("open_head"), own).alias("heads"),
    )
    each = listed.select(
        "path", "ended", "closed", F.posexplode(F.arrays_zip("ends", "starts", "heads")).alias("at", "doc")
    )
    return each.filter(
        "doc.ends IS NOT NULL AND (at < closed OR doc.starts < doc.ends)"
    ).select(
        "path",
        (F.col("ended") + F.col("at")).alias("document"),
        F.col("doc.starts").alias("start"),
        (F.col("doc.ends") - F.col("doc.starts")).alias("n_tokens"),
        F.col("doc.heads").alias("head"),
        (F.col("at") < F.col("closed")).alias("complete"),
    )


def count_tokens(spark: SparkSession, path: str, eod: int, head: int = 0, block: int = BLOCK) -> DataFrame:
    """Tokens of each document in the flat files below ``path``; see :func:`stitch`."""
    return stitch(scan_blocks(spark, path, eod, head, block))


def with_ids(counted: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) of documents written by :func:`write_token_files`."""
    digit = sum((F.element_at("head", k + 1).cast("decimal(38,0)") * BASE**k for k in range(DIGITS)), F.lit(0))
    half = F.floor(digit / 2).cast("decimal(38,0)")
    doc_id = F.when(digit == 0, F.lit(None)).when(digit % 2 == 1, half).otherwise(-half)
    return counted.select(doc_id.cast("long").alias("doc_id"), (F.col("n_tokens") - DIGITS).alias("n_tokens"))
