"""I-Match fingerprints: hashes of a text's middling rare terms, over several random lexicons and a whole one.

The lexicon holds the terms that between one in ``RAREST`` and one in
``COMMONEST`` documents contain. A document of d distinct terms brings d counts
at most, so there are no more than ``RAREST`` times the mean d of such terms,
however many documents there are. A text keeps all its terms where the lexicon
holds too few of them, as it does of a text with very many copies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.llm.common import whole_text
from taxaloom.operators.order import placed
from taxaloom.session import cut

RAREST, COMMONEST = 1000, 5
SHORT = 16                 # texts of so few terms keep them all
BAND_SHARE = 0.4           # and so do texts with a smaller share of their terms in the lexicon
WIDTHS = (3, 4, 5, 6, 6, 7, 8, 8, 9)  # a random lexicon holds one term in 2^width
CODES = 4                  # numbers of 56 bits from a term's hashes, each for so many lexicons
#: A sign for each lexicon, from those for private use, which no term holds; the last for the one with all terms.
MARKS = "".join(chr(0xE000 + n) for n in range(CODES * len(WIDTHS) + 1))
BROADCAST_TERMS = 1 << 19  # a larger lexicon is joined by shuffle
IDS = 1024                 # ids in a row that are put in order together
DIGITS, WHOLE_DIGITS = 8, 32


def terms_of(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)), "")


def marked(term: Column) -> Column:
    """The term after the mark of each lexicon that holds it; the last holds every term.

    Each random lexicon looks at some bits of a number from two hashes of the term.
    """
    digests = F.md5(term), F.md5(F.concat(term, F.lit(" ")))
    codes = [F.conv(F.substring(d, at, 14), 16, 10).cast("long") for d in digests for at in (1, 15)]
    held = []
    for number, code in enumerate(codes):
        for n, width in enumerate(WIDTHS):
            found = F.shiftright(code, sum(WIDTHS[:n])).bitwiseAND((1 << width) - 1) == 0
            held.append(F.when(found, F.concat(F.lit(MARKS[len(WIDTHS) * number + n]), term)))
    return F.array_compact(F.array(*held, F.concat(F.lit(MARKS[-1]), term)))


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): documents that hold each term, over all documents."""
    return docs.select(F.explode(terms_of(whole_text(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, held) of the terms within the band, stored; ``held`` as in :func:`marked`."""
    total = docs.count()
    counts = document_counts(docs, text_col)
    band = (F.col("n") * RAREST >= total) & (F.col("n") * COMMONEST <= total)
    return cut(counts.filter(band).select("term", marked(F.col("term")).alias("held")))


def signatures(held: Column) -> Column:
    """Per lexicon, the hash of its sorted terms; of none, of nothing. That of all terms is longer.

    ``held`` are marked terms. One sort puts the lexicons one after the other,
    each behind its mark and a line end, where the joined terms are split.
    """
    ends = F.array(*[F.lit(f"{mark}\n") for mark in MARKS])
    joined = F.translate(F.array_join(F.sort_array(F.concat(held, ends)), " "), MARKS, "")
    each = F.slice(F.split(joined, " ?\n ?", -1), 2, len(MARKS))
    digits = lambda n: F.when(n == len(MARKS) - 1, WHOLE_DIGITS).otherwise(DIGITS)
    return F.transform(each, lambda terms, n: F.substring(F.md5(terms), F.lit(1), digits(n)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the lexicons with the same terms, of those that hold a term of either; 1 if neither has terms."""
    some = lambda x: ~x.isin(*[hashlib.md5(b"").hexdigest()[:n] for n in (DIGITS, WHOLE_DIGITS)])
    used = F.zip_with(a, b, lambda x, y: (some(x) | some(y)).cast("int"))
    same = F.zip_with(a, b, lambda x, y: ((x == y) & some(x)).cast("int"))
    add = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    return F.when(add(used) == 0, F.lit(1.0)).otherwise(add(same) / add(used))


def fingerprints(texts: DataFrame, words: DataFrame, by: list[str], text_cols: list[str], note: str) -> DataFrame:
    """``by``, the text ``note`` and, for each of ``text_cols``, its signatures under the same name.

    Rows that agree in ``by`` are one. If ``texts`` is dealt out by some of
    ``by``, nothing is shuffled again. The note goes along as a term that
    begins with a space, as no word does, so that rows of terms stay small;
    its row also keeps texts without terms in the table.
    """
    if words.count() <= BROADCAST_TERMS:
        words = F.broadcast(words)
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).alias("text")) for k, c in enumerate(text_cols)])
    each = texts.select(*by, note, F.explode(sides).alias("x"))
    each = each.select(*by, note, "x.side", terms_of(whole_text("x.text")).alias("terms"))
    noted = F.array(F.concat(F.lit(" "), F.col(note)))
    each = each.select(*by, "side", (F.size("terms") <= SHORT).alias("short"), F.explode(F.concat(noted, "terms")).alias("term"))
    word = ~F.col("term").startswith(" ")
    met = each.join(words, "term", "left").withColumn("held", F.when(F.col("short"), F.coalesce("held", marked(F.col("term")))).otherwise(F.col("held")))
    known, n = F.col("held").isNotNull(), len(text_cols)
    of = lambda k, which: (F.col("side") == k) & word & which
    found = met.groupBy(*by).agg(
        F.max(F.when(~word, F.substring("term", 2, 1 << 30))).alias(note),
        *[F.flatten(F.collect_list(F.when(of(k, known), F.col("held")))).alias(f"held_{k}") for k in range(n)],
        *[F.count(F.when(of(k, known), 1)).alias(f"known_{k}") for k in range(n)],
        *[F.collect_list(F.when(of(k, ~known), F.col("term"))).alias(f"rest_{k}") for k in range(n)],
    )

    def kept(k: int) -> Column:
        held, known, rest = (F.col(f"{c}_{k}") for c in ("held", "known", "rest"))
        few = known < BAND_SHARE * (known + F.size(rest))
        return F.when(few, F.concat(held, F.flatten(F.transform(rest, marked)))).otherwise(held)

    found = found.select(*by, note, *[kept(k).alias(c) for k, c in enumerate(text_cols)])
    return found.select(*by, note, *[signatures(F.col(c)).alias(c) for c in text_cols])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(deal, at, guest, doc_id, text, next_text): each document and the text after it, by ascending id.

    Documents of ``IDS`` ids in a row are put in order together, and the first
    of the next ids is their guest, so no task sees all. The portions, of which
    there are as many as documents if ids are sparse, are put in order by ranges.
    The last document is followed by the first. Equal ids are ordered by text;
    null ids come first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("deal", F.coalesce(F.expr(f"doc_id div {IDS}"), F.lit(-(1 << 62))))
    heads = cut(placed(rows.groupBy("deal").agg(F.min("doc_id").alias("least")), [F.asc("deal")]))
    portions = heads.count()
    # The predecessor of each portion; that of the first is the last one.
    previous = heads.select(F.col("deal").alias("to"), F.pmod(F.col("place") + 1, F.lit(max(portions, 1))).alias("place"))
    # Stored, so that texts meet it without a shuffle where portions are few.
    before = cut(heads.withColumnRenamed("deal", "of").join(previous, "place").drop("place"))
    guests = rows.join(
        before, (F.col("deal") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("least"))
    ).select("doc_id", "text", F.col("to").alias("deal"), F.lit(1).alias("guest"))
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    inside = Window.partitionBy("deal").orderBy("guest", "doc_id", "text")
    return both.select(
        "deal", F.row_number().over(inside).alias("at"), "guest", "doc_id", "text",
        F.coalesce(F.lead("text").over(inside), F.lit("")).alias("next_text"),
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of documents and of edited ones, and how alike they are; see the columns.

    The edited text has the last half of the code points (rounded down)
    replaced by the first as many of the next document, or all it has.
    Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null texts are empty; repeated
    rows are documents of their own; a single document follows itself.
    """
    words = lexicon(docs, text_col)
    rows = with_next(docs, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("deal", "at", "guest", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    found = fingerprints(rows, words, ["deal", "at", "guest", "doc_id", "n_chars"], ["text", "edited"], "edited_sha256")
    inside = Window.partitionBy("deal").orderBy("at")
    found = found.withColumn("next", F.lead("text").over(inside)).filter("guest = 0")
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        F.array_join("text", "").alias("fingerprint"), F.array_join("edited", "").alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"), likeness(F.col("text"), F.col("next")).alias("near_next"),
    )
