"""Fill-in-middle transformation whose cuts are found in an indexable skip list.

A text is a list of units: runs of letters, and all other code points one by
one. The lowest lane of the list links every unit to the next; an express lane
links some units of the lane below, chosen by a hash of their rank. Each link
carries how many units and how many code points it passes, so that a descent
that adds up both comes out at the exact place of a rank.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.common import by_batch, whole_text

MARKS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix, the middle
SPARSER = 3                    # a lane has one in 2^SPARSER units of the lane below
BLOCK = 1 << 20                # code points looked at at a time


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit: ``[A-Za-z]+`` or any other single one."""
    starts, letter_before = [], False
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = (points | 32) - np.uint32(97) < 26
        inner = letter.copy()
        inner[1:] &= letter[:-1]
        inner[0] &= letter_before
        starts.append(at + np.flatnonzero(~inner))
        letter_before = bool(letter[-1])
    return np.diff(np.concatenate([*starts, [len(text)]])).astype(np.int32)


class SkipList:
    """Units in order, to be reached by rank; see the head of this module."""

    def __init__(self, widths: np.ndarray):
        self.size = len(widths)
        # A lane: units passed by each link (None: one), code points passed, places in the lane below.
        self.lanes: list[tuple] = [(None, widths, None)]
        ranks, units = np.arange(len(widths)), np.ones(len(widths), np.int64)
        points, bits = widths.astype(np.int64), 0
        while len(ranks) > 1 << SPARSER:
            bits += SPARSER
            mixed = ranks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            chosen = (mixed >> np.uint64(64 - bits)) == 0  # rank 0, the head, is in all lanes
            down = np.flatnonzero(chosen)
            units, points, ranks = np.add.reduceat(units, down), np.add.reduceat(points, down), ranks[down]
            self.lanes.append((units, points, down))

    def place(self, rank: int) -> int:
        """Code points before the unit of ``rank``; all of them for the number of units."""
        at, passed = 0, 0
        for units, points, down in reversed(self.lanes):
            while at < len(points) and rank >= (1 if units is None else units[at]):
                rank -= 1 if units is None else int(units[at])
                passed += int(points[at])
                at += 1
            if at == len(points):
                break
            at = at if down is None else int(down[at])
        return passed


def cut_ranks(doc_id: int | None, units: int, seed: int) -> tuple[int, int, int, int]:
    """Ranks of both cuts, and the rolls for leaving a text plain and for its order (0 to 99)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    first, second = sorted((h[0] % (units + 1), h[1] % (units + 1)))
    return first, second, h[2] % 100, h[3] % 100


def fill_in_middle(
    docs: DataFrame, marks: tuple[str, str, str] = MARKS, transformed: int = 90, suffix_first: int = 20, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) per row of ``docs``.

    ``n`` counts the units. Of 100 texts about ``transformed`` are cut at two
    ranks that the id and ``seed`` decide, and of these ``suffix_first`` become
    suffix, prefix, middle (form ``spm``), the others prefix, suffix, middle
    (``psm``). Empty texts and those with a mark in them stay as they are, as
    form ``plain`` without widths. A null text is empty; a null id decides like
    an empty text in its place. Repeated rows stay; other columns are not read.
    Whole texts are cut, however long.
    """
    check_marks(marks)
    has_mark = re.compile("|".join(map(re.escape, marks))).search
    before_prefix, before_suffix, before_middle = marks

    def build() -> Callable:
        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("n", "form", "output", "prefix_chars", "middle_chars")}
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                units = SkipList(unit_widths(text))
                first, second, kept, order = cut_ranks(doc_id, units.size, seed)
                out["n"].append(units.size)
                if not text or has_mark(text) or kept >= transformed:
                    form, made, a, b = "plain", text, None, None
                else:
                    a, b = units.place(first), units.place(second)
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    form = "spm" if order < suffix_first else "psm"
                    parts = (before_prefix, prefix), (before_suffix, suffix)
                    made = "".join(mark + part for mark, part in (parts if form == "psm" else parts[::-1]))
                    made += before_middle + middle
                out["form"].append(form)
                out["output"].append(made)
                out["prefix_chars"].append(a)
                out["middle_chars"].append(None if a is None else b - a)
            return out | {"doc_id": rows["doc_id"]}

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return by_batch(
        rows, build, "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long"
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text of an output of :func:`fill_in_middle`; its marks stand in it once each."""
    check_marks(marks)
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must not arise where a text meets a mark: the first character of one is nowhere else in any."""
    if len(set(marks)) != 3 or not all(marks) or any(m[0] in other[1:] for m in marks for other in marks):
        raise ValueError("marks must differ, and their first characters stand nowhere else in them")
    if any(a != b and a.startswith(b) for a in marks for b in marks):
        raise ValueError("no mark may begin with another")
