"""Byte-level BPE as a streaming transducer with bounded lookahead.

Merges are applied to a window of bytes. A byte can change the fate of earlier
ones only through a chain of merges of ever lower rank, so the merge list
itself bounds how far to the right a token depends on the text: its sufficient
lookahead. Tokens that end further than that before the window's end are stable
and leave it; the rest stays with the bytes that come next.
"""

from __future__ import annotations

import codecs
import heapq
import json
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from taxaloom.llm.common import by_batch, kept, whole_text

#: Fixed value: the pattern that splits text before the merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CHARS = 1 << 16      # characters split at a time
GROUP = 1 << 17      # words of which the unknown ones are merged side by side
LONG = 256           # bytes of a word from which on it goes through the window
WIDTHS = (8, 16, 32, 64, LONG)  # words merged side by side have at most so many bytes
REMEMBERED = 1 << 17  # words of a generation of those whose tokens a worker remembers
DECODED = 1 << 18    # tokens decoded at a time
NONE = np.iinfo(np.int32).max  # rank of a pair that does not merge


def byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file in the format of the tokenizers library."""

    def __init__(self, text: str, merges: bool = True):
        """``merges``: whether to encode; decoding needs the tokens alone."""
        model, byte = json.loads(text), byte_of_char()
        as_bytes = lambda token: bytes(byte[c] for c in token)
        ids = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.of_id = {i: as_bytes(t) for t, i in ids.items()}
        self.of_id |= {i: t.encode() for t, i in self.special.items()}
        if not merges:
            return
        self.of_byte = [0] * 256
        for i, t in self.of_id.items():
            if len(t) == 1:
                self.of_byte[t[0]] = i
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        self.pairs = {(a, b): (rank, ab) for rank, (a, b, ab) in enumerate(self.merges)}
        self.lookahead = sufficient_lookahead(self.merges, self.of_id)


def sufficient_lookahead(merges: list[tuple[int, int, int]], of_id: dict[int, bytes]) -> int:
    """Bytes after a token's end that can have a say in it.

    ``taken[y]``: how far to the right of a token y one must look to know if a
    merge so far takes it as its left part; for a merge (y, w) that is w and
    whatever w's own forming depends on. ``formed[t]``: the same for the parts
    on t's right edge, each until the merge that makes it part of t. Merges in
    order of rank need what lower ranks left in both.
    """
    taken: dict[int, int] = {}
    formed: dict[int, int] = {}
    for left, right, both in merges:
        edge = max(taken.get(right, 0), formed.get(right, 0))
        taken[left] = max(taken.get(left, 0), len(of_id[right]) + edge)
        formed[both] = max(formed.get(both, 0), edge)
    return max([0, *taken.values(), *formed.values()])


class Encoder:
    """Tokens of words, remembered for a bounded number of words.

    Words are remembered in two generations: when the younger is full it
    becomes the older, which is forgotten but for the words seen again.
    """

    def __init__(self, vocabulary: Vocabulary, special: bool = True):
        import regex

        self.v = vocabulary
        self.split = regex.compile(PATTERN).findall
        self.border = regex.compile(r"\S(?=\s)").search
        strings = map(regex.escape, vocabulary.special if special else ())
        self.special = regex.compile("|".join(strings) or r"(?!)")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        made = np.array([m[2] for m in vocabulary.merges] or [0], np.int32)
        pairs = np.array([a << 32 | b for a, b, _ in vocabulary.merges] or [-1], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.made, self.pairs, self.ranks = made, pairs[order], order.astype(np.int32)
        self.of_byte = np.array(vocabulary.of_byte, np.int32)

    def merged(self, ids: list[int]) -> list[int]:
        """Merges of the least rank first, the leftmost of equal rank."""
        pairs = self.v.pairs
        if len(ids) > 48:
            return self._merged_by_heap(ids)
        while len(ids) > 1:
            best, at = None, 0
            for i, pair in enumerate(zip(ids, ids[1:])):
                found = pairs.get(pair)
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        pairs, n = self.v.pairs, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*pairs[p], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in pairs]
        heap = [(rank, i, made, p) for rank, made, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], k, pairs[p][1], p))
        return [t for t in ids if t >= 0]

    def stream(self, pieces: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one word given in pieces; memory is bounded by the lookahead and a piece."""
        window, ahead = b"", self.v.lookahead
        for piece in pieces:
            window += piece
            if len(window) < 2 * ahead:
                continue
            done = 0
            for token in self.merged([self.v.of_byte[b] for b in window]):
                end = done + len(self.v.of_id[token])
                if end + ahead > len(window):
                    break
                yield token
                done = end
            window = window[done:]
        yield from self.merged([self.v.of_byte[b] for b in window])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of pairs of tokens, -1 for no token."""
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def side_by_side(self, words: list[bytes], width: int) -> list[bytes]:
        """Packed tokens of words of at most ``width`` bytes, each a whole window.

        Every round makes one merge in each word that has one, as :meth:`merged` does.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.full((len(words), width + 1), -1, np.int32)
        ids[np.arange(width + 1) < lengths[:, None]] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(words)), [b""] * len(words)
        places = np.arange(width + 1)
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            live = best < NONE
            if not live.all():
                done = ids[~live]
                shown = done >= 0
                packed = done[shown].astype("<u4").tobytes()
                ends = (4 * shown.sum(axis=1).cumsum()).tolist()
                for row, start, end in zip(rows[~live].tolist(), [0, *ends], ends):
                    out[row] = packed[start:end]
                ids, rank, rows, at, best = ids[live], rank[live], rows[live], at[live], best[live]
                if not len(rows):
                    break
            # The last places are always free, so what moves up from there is no token.
            behind = places > at[:, None]
            ids[:, :-1] = np.where(behind[:, :-1], ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(behind[:, :-2], rank[:, 1:], rank[:, :-1])
            row = np.arange(len(rows))
            ids[row, at] = self.made[best]
            rank[row, at] = self._rank(ids[row, at], ids[row, at + 1])
            inner = np.flatnonzero(at)
            before = at[inner] - 1
            rank[inner, before] = self._rank(ids[inner, before], ids[inner, before + 1])
        return out

    def _learn(self, words: set[str]) -> list[str]:
        """Have all ``words`` in the younger generation; those that are too long to stay there."""
        young, old, unknown, long = self.young, self.old, [], []
        for word in words:
            if word not in young:
                if word in old:
                    young[word] = old[word]
                else:
                    unknown.append(word)
        data = [word.encode() for word in unknown]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        low = 0
        for width in WIDTHS:
            part = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            young.update(zip([unknown[i] for i in part], self.side_by_side([data[i] for i in part], width)))
            low = width
        step = max(LONG, self.v.lookahead)
        for i in np.flatnonzero(sizes > LONG).tolist():
            pieces = (data[i][k:k + step] for k in range(0, len(data[i]), step))
            young[unknown[i]] = array("I", self.stream(pieces)).tobytes()
            long.append(unknown[i])
        return long

    def texts(self, texts: Iterable[str]) -> list[bytes]:
        """Token ids of each text as unsigned 32-bit integers, little-endian."""
        out: list[list[bytes]] = []
        held: list[tuple[int, list[str] | bytes]] = []
        size = 0

        def settle() -> None:
            long = self._learn({w for _, words in held if isinstance(words, list) for w in words})
            for number, words in held:
                special = isinstance(words, bytes)
                out[number].append(words if special else b"".join(map(self.young.__getitem__, words)))
            for word in long:
                del self.young[word]
            if len(self.young) >= REMEMBERED:
                self.young, self.old = {}, self.young
            held.clear()

        for number, text in enumerate(texts):
            out.append([])
            for words in self._pieces(text):
                held.append((number, words))
                size += len(words)
                if size >= GROUP:
                    settle()
                    size = 0
        settle()
        return [b"".join(parts) for parts in out]

    def text(self, text: str) -> bytes:
        return self.texts([text])[0]

    def _pieces(self, text: str) -> Iterator[list[str] | bytes]:
        """The words of a text in pieces, and its special tokens packed."""
        at = 0
        for special in self.special.finditer(text):
            yield from self._plain(text[at:special.start()])
            yield array("I", [self.v.special[special.group()]]).tobytes()
            at = special.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        """White space only begins words, so a cut before it changes no word."""
        start = 0
        while start < len(text):
            border = self.border(text, start + CHARS) if start + CHARS < len(text) else None
            end = border.end() if border else len(text)
            yield self.split(text[start:end])
            start = end


def decoded(ids: bytes, of_id: dict[int, bytes]) -> str:
    """Text of packed ids; bytes that are no UTF-8 become U+FFFD.

    The decoder keeps the bytes of a character that later tokens complete.
    """
    state, out = codecs.getincrementaldecoder("utf-8")("replace"), []
    tokens = array("I", ids)
    for i in range(0, len(tokens), DECODED):
        out.append(state.decode(b"".join(map(of_id.__getitem__, tokens[i:i + DECODED]))))
    return "".join([*out, state.decode(b"", True)])


def encoder_of(file: str, special: bool) -> Encoder:
    """The encoder of a vocabulary file's text; a worker keeps it for its next tasks."""
    return kept("encoder", (file, special), lambda: Encoder(Vocabulary(file), special))


def tokens_of(file: str) -> dict[int, bytes]:
    """The bytes of each token, kept as in :func:`encoder_of`."""
    return kept("tokens", file, lambda: Vocabulary(file, merges=False).of_id)


def read_vocabulary(df: DataFrame, path: str):
    """The vocabulary file, read on the driver and sent to the workers once."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", special: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids) per row; ``ids`` are packed as unsigned 32-bit little-endian integers.

    Whole texts are encoded as the tokenizers library does without adding
    special tokens; their strings within a text become their ids, or ordinary
    text if not ``special``. A null or empty text has no tokens. Repeated rows and null ids stay; other columns
    are not read.
    """
    file = read_vocabulary(docs, vocabulary)

    def build() -> Callable:
        encoder = encoder_of(file.value, special)

        def step(rows: dict[str, list]) -> dict[str, list]:
            ids = encoder.texts(rows["text"])
            return {"doc_id": rows["doc_id"], "n_tokens": [len(i) // 4 for i in ids], "ids": ids}

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return by_batch(rows, build, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids) with the text of ``ids``; null ids decode to an empty text."""
    file = read_vocabulary(tokens, vocabulary)

    def build() -> Callable:
        of_id = tokens_of(file.value)

        def step(rows: dict[str, list]) -> dict[str, list]:
            return rows | {"text": [decoded(i or b"", of_id) for i in rows["ids"]]}

        return step

    rows = tokens.select("doc_id", "n_tokens", "ids")
    return by_batch(rows, build, "doc_id long, n_tokens long, ids binary, text string")
