"""Short license notices found in texts, with a bounded number of edits.

A notice of which k characters may be edited is cut into k + 1 pieces. However
the edits fall, one piece stays whole, so an exact search for all pieces of all
notices (one pass of an Aho-Corasick automaton) finds a candidate for each
place of a notice. There the regex library matches the notice with at most k
errors and gives its span and the number of edits.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.common import by_batch, whole_text

#: Phrases whose exact places are counted, and their labels.
BASE = (
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("gpl", "gnu general public license"),
    ("mit", "mit license"),
)
#: Further notices, words of the licenses they stand for.
FURTHER = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("cc-by", "creative commons attribution"),
    ("gpl", "this program is free software you can redistribute it"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
CHARS_PER_EDIT = 12  # a notice may have one edit for each so many characters, rounded

# Words: A-Z as a-z; digits, a-z and all that is not ASCII stay, the rest parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same in the text as it is


def folded(text: str) -> str:
    """The words of a text with one space between them."""
    return b" ".join(text.encode("utf-8", "replace").translate(_FOLD).split()).decode()


def edits_allowed(phrase: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return (2 * len(phrase) + chars_per_edit) // (2 * chars_per_edit)


def pieces_of(phrase: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(phrase) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


@dataclass
class Hit:
    notice: int
    start: int  # in the folded text
    end: int
    edits: int


class Scanner:
    """Places of notices in folded texts."""

    def __init__(self, notices: list[tuple[str, str]], chars_per_edit: int):
        import ahocorasick
        import regex

        self.phrases = [phrase for _, phrase in notices]
        self.edits = [edits_allowed(p, chars_per_edit) for p in self.phrases]
        seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (phrase, edits) in enumerate(zip(self.phrases, self.edits)):
            for place, piece in pieces_of(phrase, edits):
                seeds[piece].append((number, place))
        self.seeds = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        # Whole words only: a space or an end of the text on both sides.
        self.match = [
            regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(p)}){{e<={k}}}(?![^ ])").search
            for p, k in zip(self.phrases, self.edits)
        ]

    def hits(self, text: str) -> list[Hit]:
        """All exact places, and places with edits that overlap no better place of the same notice."""
        found: dict[int, dict[tuple[int, int], int]] = defaultdict(dict)
        seen = set()
        for last, (size, where) in self.seeds.iter(text):
            for number, place in where:
                start = last + 1 - size - place
                if (number, start) not in seen:
                    seen.add((number, start))
                    self._verify(text, number, start, found[number])
        return [hit for number in sorted(found) for hit in self._best(number, found[number])]

    def _verify(self, text: str, number: int, start: int, found: dict[tuple[int, int], int]) -> None:
        phrase, edits = self.phrases[number], self.edits[number]
        end = start + len(phrase)
        if start >= 0 and text.startswith(phrase, start) and text[max(0, start - 1):start] in ("", " ") and text[end:end + 1] in ("", " "):
            found[start, end] = 0
        elif edits:
            # Edits move the begin by as many places at most; one more shows what follows the end.
            hit = self.match[number](text, max(0, start - edits), end + 2 * edits + 1)
            if hit:
                a, b = hit.span()
                a, b = a + (text[a] == " "), b - (text[b - 1] == " ")
                count = sum(hit.fuzzy_counts)
                found[a, b] = min(found.get((a, b), count), count)

    @staticmethod
    def _best(number: int, found: dict[tuple[int, int], int]) -> list[Hit]:
        kept: list[tuple[int, int]] = []  # ends ascend with begins
        hits = []
        for (start, end), edits in sorted(found.items(), key=lambda f: (f[1], f[0])):
            at = bisect(kept, (start, end))
            free = (not at or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0])
            if free or not edits:
                kept.insert(at, (start, end))
                hits.append(Hit(number, start, end, edits))
        return hits


HITS = (
    "array<struct<label string, phrase string, first_word long, last_word long, start long, end long, edits int,"
    " likeness double, base boolean>>"
)


def scan(
    docs: DataFrame, base: tuple[tuple[str, str], ...] = BASE, further: tuple[tuple[str, str], ...] = FURTHER,
    chars_per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, hits) per row of ``docs``: where its text holds a notice.

    A hit has the words of its span (from 0, both inclusive), its code points
    in the text as it is, its edits, its likeness (1 less the edits for each
    character of the notice), and whether it is an exact place of a phrase of
    ``base``. Hits are in the order of their begin. Notices are given folded:
    lower-case words with single spaces. Null and empty texts have no words and
    no hits; null ids and repeated rows stay; texts are searched whole; other
    columns are not read.
    """
    notices = [*base, *further]

    def build() -> Callable:
        import regex

        scanner, words = Scanner(notices, chars_per_edit), regex.compile(WORD)

        def placed(text: str, plain: str, hits: list[Hit]) -> list[dict]:
            hits.sort(key=lambda h: (h.start, h.end, h.notice))
            ends, at, word = [], 0, 0
            for place in sorted({p for h in hits for p in (h.start, h.end)}):
                word += plain.count(" ", at, place)
                at = place
                ends.append((place, word))
            word_at = dict(ends)
            wanted = {w for h in hits for w in (word_at[h.start], word_at[h.end])}
            spans, last = {}, max(wanted)
            for number, m in enumerate(words.finditer(text)):
                if number in wanted:
                    spans[number] = m.span()
                if number >= last:
                    break
            rows = []
            for h in hits:
                label, phrase = notices[h.notice]
                first, end = word_at[h.start], word_at[h.end]
                rows.append({
                    "label": label, "phrase": phrase, "first_word": first, "last_word": end,
                    "start": spans[first][0], "end": spans[end][1], "edits": h.edits,
                    "likeness": 1 - h.edits / len(phrase), "base": h.edits == 0 and h.notice < len(base),
                })
            return rows

        def step(rows: dict[str, list]) -> dict[str, list]:
            counts, found = [], []
            for text in rows["text"]:
                plain = folded(text)
                hits = scanner.hits(plain)
                counts.append(plain.count(" ") + 1 if plain else 0)
                found.append(placed(text, plain, hits) if hits else [])
            return {"doc_id": rows["doc_id"], "n_words": counts, "hits": found}

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return by_batch(rows, build, f"doc_id long, n_words long, hits {HITS}")


def labels_in(hits: Column) -> Column:
    """Distinct labels, sorted, comma-joined; empty without hits."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
