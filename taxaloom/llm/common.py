"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Texts are handed to Python functions in pieces of about so many characters.
PIECE_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that name a document: its id and a hash of its text.

    They are the same in every scan, unlike numbers given to rows. Rows that
    agree in id and text are one document given more than once.
    """
    return [F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("body")]


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until ``df`` has no such column."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        free.append(name)
    return free


def kept(name: str, of: Any, make: Callable[[], Any]) -> Any:
    """``make()``, which this worker process keeps under ``name`` while ``of`` is the same.

    It hangs on ``sys``, since each task gets functions and module variables of
    its own (they are pickled by value).
    """
    store = sys.__dict__.setdefault("_taxaloom_kept", {})
    if name not in store or store[name][0] != of:
        store[name] = (of, make())
    return store[name][1]


def by_batch(
    rows: DataFrame, build: Callable[[], Callable[[dict[str, list] | None], dict[str, list]]], schema: str,
    flush: bool = False,
) -> DataFrame:
    """``build()`` once per task; its result on columns as lists, batch by batch.

    Batches are cut so that long texts never pile up in a worker. With
    ``flush`` it is called with None at a task's end, for what it still holds.
    """
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = build()
        given = ({c: p.column(i).to_pylist() for i, c in enumerate(columns)} for p in _parts(batches))
        for part in chain(given, [None] if flush else []):
            found = step(part)
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return rows.mapInArrow(run, schema)


def filter_by_batch(rows: DataFrame, column: str, build: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows whose ``column`` the function that ``build`` makes once per task finds good; columns stay as they are."""
    place = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = build()
        for part in _parts(batches):
            yield part.filter(pa.array(good(part.column(place).to_pylist()), pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for end in _pieces(batch):
            yield batch.slice(start, end - start)
            start = end
        del batch
        give_back_memory()


def give_back_memory() -> None:
    """Freed memory goes back to the system; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _pieces(batch: pa.RecordBatch) -> list[int]:
    """Row numbers at which a piece of a batch ends."""
    size, ends = 0, []
    sizes = [0] * batch.num_rows
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            import pyarrow.compute as pc

            for i, n in enumerate(pc.binary_length(column).to_pylist()):
                sizes[i] += n or 0
    for i, n in enumerate(sizes):
        size += n + 64
        if size >= PIECE_CHARS:
            ends.append(i + 1)
            size = 0
    if not ends or ends[-1] != batch.num_rows:
        ends.append(batch.num_rows)
    return ends
