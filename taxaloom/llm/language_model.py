"""Log-bilinear neural language model over word classes, trained by noise-contrastive estimation.

Frequent words are classes of their own, all others share classes by their last
bytes. Two context vectors, each scaled element by element, predict the vector
of the next class; within a shared class a word has its smoothed share of the
class's training tokens. The contexts are so few that one batched matrix
product gives the normalised probabilities of all classes after each of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.common import by_batch, whole_text
from taxaloom.session import cut

OWN, SHARED = 256, 255          # classes of single words, and of words by ending
CLASSES = 1 + OWN + SHARED      # class 0 is the end of a text
NEAR, FAR = 31, 32              # context classes of single words, and by ending
CONTEXTS = 1 + NEAR + FAR       # context class 0 is the beginning of a text
TABLE_WORDS = 1 << 18           # words that every task knows; others are joined
FLUSH = 1 << 19                 # words counted in a task at a time
STEPS, BATCH, NOISE, SIZE, RATE = 1200, 8192, 64, 32, 0.05


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32((word.rstrip(b".,;:!?") or word)[-3:])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id as text leaves 2 when divided by 7; null ids do not."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % 7 == 2


@dataclass
class Table:
    """What tasks know of the training tokens: the frequent words, and sizes of classes."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int                 # N
    distinct: int               # V
    ends: int
    shared_tokens: np.ndarray   # by ending, without words of their own class
    shared_words: np.ndarray
    number: dict = field(default_factory=dict, repr=False)

    def prepare(self) -> Table:
        """Numbers of words, most frequent first; a word not in the table gets one by its ending."""
        n = len(self.words)
        self.number = _Numbers({w: i for i, w in enumerate(self.words)})
        self.number.size = n
        by_end = np.array([ending(w) for w in self.words], np.int64)
        rank = np.arange(n)
        # After the table's words come the endings of all others, one number per pair of classes.
        every = np.arange(SHARED * FAR)
        self.class_of = np.concatenate([
            np.where(rank < OWN, 1 + rank, 1 + OWN + by_end % SHARED), 1 + OWN + every // FAR
        ]).astype(np.int32)
        self.context_of = np.concatenate([
            np.where(rank < NEAR, 1 + rank, 1 + NEAR + by_end % FAR), 1 + NEAR + every % FAR
        ]).astype(np.int32)
        self.log_count = np.concatenate([np.log10(self.counts + 1.0), np.zeros(SHARED * FAR)])
        # log10 of the share within the class, without the word's own count.
        share = np.concatenate([
            np.zeros(1 + OWN), -np.log10(self.shared_tokens + self.shared_words + 1.0)
        ])
        self.within = share[self.class_of] + np.where(self.class_of > OWN, self.log_count, 0.0)
        return self

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def contexts(self, numbers: np.ndarray) -> np.ndarray:
        """Number of the two contexts before each word, and before the end."""
        before = np.zeros(len(numbers) + 2, np.int64)
        before[2:] = self.context_of[numbers]
        return before[:-1] * CONTEXTS + before[1:]

    def classes(self, numbers: np.ndarray) -> np.ndarray:
        return np.append(self.class_of[numbers], 0)


class _Numbers(dict):
    size = 0

    def __missing__(self, word: bytes) -> int:
        end = ending(word)
        return self.size + end % SHARED * FAR + end % FAR


def count_words(training: DataFrame) -> DataFrame:
    """(word, ending, n) over all training texts; counted in tasks first, a bounded number of words at a time."""

    def build() -> Callable:
        def step(rows: dict[str, list]) -> dict[str, list]:
            words, ends, counts = [], [], []
            counter: Counter = Counter()

            def flush():
                words.extend(counter)
                counts.extend(counter.values())
                ends.extend(ending(w) % SHARED for w in counter)
                counter.clear()

            for text in rows["text"]:
                counter.update(words_of(text))
                if len(counter) > FLUSH:
                    flush()
            flush()
            return {"word": words, "ending": ends, "n": counts}

        return step

    partial = by_batch(training.select("text"), build, "word string, ending int, n long")
    return partial.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def build_table(counts: DataFrame, ends: int, table_words: int = TABLE_WORDS) -> tuple[Table, int]:
    """The table, and the count from which on all words are in it.

    At most ``table_words`` words, whatever the size of the corpus; the least
    count is found from a histogram by powers of 2^(1/16).
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    words, least = 0, None
    for r in sorted(levels, key=lambda r: -r.level):
        if words + r.words > table_words:
            break
        words, least = words + r.words, r.level
    floor = 1 << 62 if least is None else next(n for n in _counts_from(least))
    known = counts.filter(F.col("n") >= floor).select("word", "n").toArrow().to_pandas()
    known = known.sort_values(["n", "word"], ascending=[False, True])
    by_ending = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    tokens, distinct = np.zeros(SHARED), np.zeros(SHARED)
    for r in by_ending:
        tokens[r.ending], distinct[r.ending] = r.n, r.words
    listed = [w.encode() for w in known["word"]]
    for w, n in zip(listed[:OWN], known["n"].to_numpy()[:OWN]):
        tokens[ending(w) % SHARED] -= n
        distinct[ending(w) % SHARED] -= 1
    every = sum(r.n for r in levels)
    table = Table(
        listed, known["n"].to_numpy(np.int64), every + ends, sum(r.words for r in levels) + (ends > 0), ends,
        tokens, distinct,
    )
    return table, floor


def _counts_from(level: int):
    """Counts whose level is ``level`` or more, the least first."""
    n = max(1, int(2 ** (level / 16)) - 1)
    while int(np.floor(np.log2(n) * 16)) < level:
        n += 1
    yield n


def count_contexts(training: DataFrame, table) -> DataFrame:
    """(cell, n): how often each class follows each pair of contexts, over all training texts."""

    def build() -> Callable:
        t = table.value.prepare()

        def step(rows: dict[str, list]) -> dict[str, list]:
            cells = []
            for text in rows["text"]:
                numbers = t.numbers(words_of(text))
                cells.append(t.contexts(numbers) * CLASSES + t.classes(numbers))
            cell, n = np.unique(np.concatenate(cells or [np.zeros(0, np.int64)]), return_counts=True)
            return {"cell": cell, "n": n}

        return step

    partial = by_batch(training.select("text"), build, "cell long, n long")
    return partial.groupBy("cell").agg(F.sum("n").alias("n"))


def train(cell: np.ndarray, n: np.ndarray, steps: int = STEPS, seed: int = 7) -> np.ndarray:
    """log10 probabilities (contexts x contexts, classes) of a log-bilinear model.

    ``cell`` and ``n`` are the counts of :func:`count_contexts`, of a number
    of cells that does not depend on the corpus. Each step holds a batch of
    them against noise drawn from the classes' frequencies, shared by the batch.
    """
    rng = np.random.default_rng(seed)
    order = np.argsort(cell)
    cell, n = cell[order], n[order].astype(np.float64)
    unigram = np.bincount(cell % CLASSES, n, CLASSES) + 0.5
    unigram /= unigram.sum()
    bias = np.log(unigram).astype(np.float32)
    log_noise = np.log(NOISE * unigram).astype(np.float32)
    params = {
        "far": rng.normal(0, 0.1, (CONTEXTS, SIZE)), "near": rng.normal(0, 0.1, (CONTEXTS, SIZE)),
        "scale_far": np.ones(SIZE), "scale_near": np.ones(SIZE),
        "out": rng.normal(0, 0.1, (CLASSES, SIZE)), "bias": bias,
    }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    total = np.cumsum(n)
    for step in range(1, (steps if len(cell) else 0) + 1):
        drawn = cell[np.searchsorted(total, rng.random(BATCH) * total[-1], side="right").clip(0, len(cell) - 1)]
        target, context = drawn % CLASSES, drawn // CLASSES
        a, b = context // CONTEXTS, context % CONTEXTS
        noise = rng.choice(CLASSES, NOISE, p=unigram)
        p = params
        guess = p["far"][a] * p["scale_far"] + p["near"][b] * p["scale_near"]
        true = (guess * p["out"][target]).sum(1) + p["bias"][target] - log_noise[target]
        false = guess @ p["out"][noise].T + p["bias"][noise] - log_noise[noise]
        d_true = -_sigmoid(-true) / BATCH
        d_false = _sigmoid(false) / BATCH
        d_guess = d_true[:, None] * p["out"][target] + d_false @ p["out"][noise]
        grads = {
            "far": _summed(a, d_guess * p["scale_far"], CONTEXTS),
            "near": _summed(b, d_guess * p["scale_near"], CONTEXTS),
            "scale_far": (d_guess * p["far"][a]).sum(0), "scale_near": (d_guess * p["near"][b]).sum(0),
            "out": _summed(target, d_true[:, None] * guess, CLASSES) + _summed(noise, d_false.T @ guess, CLASSES),
            "bias": np.bincount(target, d_true, CLASSES) + np.bincount(noise, d_false.sum(0), CLASSES),
        }
        rate = RATE * (1 - step / (steps + 1))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            params[k] = (params[k] - rate * move).astype(np.float32)
    a, b = np.divmod(np.arange(CONTEXTS * CONTEXTS), CONTEXTS)
    p = params
    scores = (p["far"][a] * p["scale_far"] + p["near"][b] * p["scale_near"]) @ p["out"].T + p["bias"]
    scores = scores.astype(np.float64)
    top = scores.max(1, keepdims=True)
    scores -= top + np.log(np.exp(scores - top).sum(1, keepdims=True))
    return (scores / np.log(10)).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    one_hot = np.zeros((size, len(index)), np.float32)
    one_hot[index, np.arange(len(index))] = 1
    return one_hot @ rows.astype(np.float32)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_words: int = TABLE_WORDS) -> DataFrame:
    """Scores per row of ``docs`` under a model of those that are not :func:`held_out`.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, both scores in log10. Words, counts and contexts come from all
    training texts. A null or empty text is one end. With no training text all
    words are unknown and all classes equally likely. Repeated rows are rows
    (and training texts) of their own.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
        held_out(id_col).alias("held_out"),
    )
    training = rows.filter("NOT held_out")
    counts = cut(count_words(training))
    ends = training.select("doc_id").count()
    table, floor = build_table(counts, ends, table_words)
    shipped = spark.sparkContext.broadcast(table)
    cells = count_contexts(training, shipped).toArrow()  # at most CONTEXTS^2 * CLASSES rows
    model = spark.sparkContext.broadcast(train(cells["cell"].to_numpy(), cells["n"].to_numpy()))
    norm = float(np.log10(table.tokens + table.distinct + 1.0))
    end_count = float(np.log10(ends + 1.0))

    def build() -> Callable:
        t, log_p = shipped.value.prepare(), model.value

        def step(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in names}
            for row, doc_id, text, held in zip(rows["row"], rows["doc_id"], rows["text"], rows["held_out"]):
                words = words_of(text)
                numbers = t.numbers(words)
                known = numbers < len(t.words)
                logs = log_p[t.contexts(numbers), t.classes(numbers)].sum(dtype=np.float64)
                found = (
                    row, doc_id, held, len(words) + 1, int(known.sum()) + (ends > 0),
                    float(t.log_count[numbers].sum() + end_count - norm * (len(words) + 1)),
                    float(logs + t.within[numbers].sum()),
                    f" {row}", 0,
                )
                for k, v in zip(names, found):
                    out[k].append(v)
                rare = Counter(words[i] for i in np.flatnonzero(~known))
                for k in names[1:7]:
                    out[k].extend([None] * len(rare))
                out["row"].extend([row] * len(rare))
                out["word"].extend(rare)
                out["times"].extend(rare.values())
            return out

        return step

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "word", "times"]
    scored = by_batch(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out"), build,
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double,"
        " score double, word string, times long",
    )
    # No word holds a space, so the rows of documents meet no count and are spread evenly.
    rest = counts.filter(F.col("n") < floor).select("word", "n")
    met = scored.join(rest, "word", "left")
    gain = F.coalesce(F.col("times") * F.log10(F.col("n") + 1), F.lit(0.0))
    return (
        met.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
            F.sum(F.coalesce("n_known", F.when(F.col("n").isNotNull(), F.col("times")), F.lit(0))).alias("n_known"),
            F.sum(F.coalesce("base_score", F.lit(0.0)) + gain).alias("base_score"),
            F.sum(F.coalesce("score", F.lit(0.0)) + gain).alias("score"),
        )
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(table.tokens).cast("long").alias("train_tokens"),
            "base_score", "score",
        )
    )
