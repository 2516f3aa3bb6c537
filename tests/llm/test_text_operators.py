import hashlib
import os
import re
import subprocess
import sys
import zlib
from array import array
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxaloom.llm import bpe, chat, decontaminate, imatch, language_model, line_dedup, token_files, toxicity

DOCS = "doc_id long, text string, __id string, shift int, term string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def docs_of(spark, texts):
    """Documents with null, empty and repeated rows, and columns whose names clash with inner ones."""
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(900, None, "x", 1, "y"), (901, "", None, None, None), (902, "twice", "a", 1, "b"),
                                         (902, "twice", "a", 1, "b"), (None, "no id", "a", 1, "b")], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


# --- chat --------------------------------------------------------------------

def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")


def test_windows_keep_system_repeat_history_and_mask_it(spark):
    rows = [(1, 0, "system", "be kind", "z")]
    rows += [(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "a " * 10, "z") for k in range(1, 9)]
    found = chat.format_chats(turns_of(spark, rows), budget=60, history=20).orderBy("window").collect()
    assert len(found) > 2
    for w in found:
        assert w.n_tokens <= 60 and w.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n")
    assert found[0].repeated == 0 and all(w.repeated == 2 for w in found[1:])
    shown = [w.text[s.start:s.start + s.length] for w in found for s in w.loss_spans]
    assert shown == [r[3] for r in rows if r[2] == "assistant"]


def test_marks_within_texts_come_back(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "\\0 \\1 <\\1| \\", "a\nb", "", None, "<<||", "é😀<|"]
    rows = [(c, t, role, text, "z") for c in (1, None) for t, text in enumerate(odd) for role in ("user\n<|x", "assistant")]
    rows += [(2, 0, "system", "alone", "z"), (3, None, None, None, None), (3, None, None, None, None)]
    windows = chat.format_chats(turns_of(spark, rows), budget=30, history=9)
    back = chat.read_loss(chat.read_turns(windows)).orderBy("conv_id", "window").collect()
    for conv in (1, None, 2, 3):
        got = [(t.role, t.text) for w in back if w.conv_id == conv for t in w.turns]
        want = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        assert got == [(r, x) for _, _, r, x in want]
        said = [x for w in back if w.conv_id == conv for x in w.targets]
        assert said == [x for _, _, r, x in want if r == "assistant"]
    assert chat.format_chats(turns_of(spark, [])).count() == 0


# --- I-Match -----------------------------------------------------------------

def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(spark, empty):
    texts = [words(60, 7 * k) for k in range(12)] + ["", "..", words(60, 0)]
    rows = imatch.edited_likeness(docs_of(spark, texts)).collect()
    assert len(rows) == len(texts) + 5
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == by_id[14].fingerprint
    assert by_id[12].fingerprint == by_id[13].fingerprint == by_id[900].fingerprint
    assert by_id[12].near_next == 1.0                     # neither has terms
    edited = texts[0][: len(texts[0]) - len(texts[0]) // 2] + texts[1][: len(texts[0]) // 2]
    assert by_id[0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    last = next(r for r in rows if r.doc_id == 902)
    assert last.n_chars == 5 and all(0 <= r.near_edited <= 1 for r in rows)
    assert imatch.edited_likeness(empty.limit(0)).count() == 0


def test_texts_outside_the_band_keep_their_terms(spark):
    copied, lone = words(200, 1000), words(60, 5000)
    band = [words(130, 3000 + 50 * (k % 40)).split() for k in range(790)]
    texts = [copied] * 400                               # over a fifth of the rows, as are the words "common"
    texts += [" ".join(w for pair in zip(b, [f"common{i}" for i in range(70)] + [""] * 60) for w in pair) for b in band]
    texts += [words(190, 9000), lone] + [words(200, 2000)] * 400
    rows = {r.doc_id: r for r in imatch.edited_likeness(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0].fingerprint == rows[1].fingerprint != rows[len(texts) - 1].fingerprint
    assert rows[1].near_next == 1.0
    assert rows[len(texts) - 1].near_next < 0.1           # followed by the first group's text
    assert 0 < rows[399].near_edited < 1.0                # its other half brings terms of the band
    assert rows[1191].fingerprint != rows[1190].fingerprint


def test_each_document_is_followed_by_the_next_id(spark):
    """Dense and sparse ids, repeated ones and a null id, which comes first."""
    ids = [None, *range(-3, 5), *range(0, 10**7, 2 * 10**5), 7 << 40, 7 << 40]
    rows = sorted(((i, f"t{n}") for n, i in enumerate(ids)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = imatch.with_next(docs).filter("guest = 0").collect()
    after = dict(zip((t for _, t in rows), [*(t for _, t in rows[1:]), rows[0][1]]))
    assert {r.text: r.next_text for r in got} == after and len(got) == len(rows)
    one = imatch.with_next(docs.limit(1)).filter("guest = 0").first()
    assert one.next_text == one.text


def test_unlike_texts_share_no_fingerprint(spark):
    texts = ["", *[f"w{k}" for k in range(60)], *[f"w{k} x{k}" for k in range(60)]]
    rows = imatch.edited_likeness(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len({r.fingerprint for r in rows}) == len(texts)
    assert all(r.near_next < 1.0 for r in rows)


# --- BPE and token files -----------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(open(VOCABULARY, encoding="utf-8").read()))


def test_tokens_are_those_of_the_library(encoder):
    library = Tokenizer.from_file(VOCABULARY)
    rng = np.random.default_rng(5)
    texts = ["", "a" * 5000, "=-" * 3000, " \n" * 3000, "x<|endoftext|> y", "don't I'll ÉÉ 😀 \x1c\x85 z"]
    texts += ["".join(rng.choice(list("etaoin  é\n.'"), 3000)) for _ in range(5)]
    for text in texts:
        ids = encoder.text(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", ids)) == want
        assert bpe.decoded(ids, encoder.v.of_id) == library.decode(want, skip_special_tokens=False)
    assert bpe.decoded(array("I", [encoder.v.of_byte[0xE2]]).tobytes(), encoder.v.of_id) == "�"


def test_streaming_in_any_pieces_gives_the_same(encoder):
    word = ("abcab" * 300).encode()
    whole = encoder.merged([encoder.v.of_byte[b] for b in word])
    for step in (1, 7, 1000):
        assert list(encoder.stream(word[i:i + step] for i in range(0, len(word), step))) == whole


def test_encode_and_decode_tables(spark, empty):
    docs = docs_of(spark, ["Hello world", "ünï"])
    both = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    assert sorted((r.doc_id or -1, r.text) for r in both) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    assert bpe.encode(empty, VOCABULARY).count() == 0


def test_token_counts_of_flat_files(spark, empty, tmp_path):
    docs = docs_of(spark, ["a b c", "word " * 700, "<|endoftext|>"])
    tokens = bpe.encode(docs, VOCABULARY, special=False)
    token_files.write_token_files(tokens, f"{tmp_path}/t", 50_256)
    token_files.write_text_files(docs, f"{tmp_path}/u", 50_256, VOCABULARY)
    for block, files in ((3, "t"), (1000, "t"), (1000, "u")):
        counted = token_files.count_tokens(spark, f"{tmp_path}/{files}", 50_256, token_files.DIGITS, block)
        assert all(r.complete for r in counted.collect())
        got = sorted((str(r.doc_id), r.n_tokens) for r in token_files.with_ids(counted).collect())
        assert got == sorted((str(r.doc_id), r.n_tokens) for r in tokens.collect())


def test_files_without_last_separator(spark, tmp_path):
    flat = [1, 2, 9, 9, 3, 4, 5, 9, 7]
    (tmp_path / "f").write_bytes(np.array(flat, "<u2").tobytes())
    for block in (1, 2, 4, 100):
        rows = token_files.count_tokens(spark, str(tmp_path), 9, 1, block).orderBy("document").collect()
        assert [(r.document, r.start, r.n_tokens, r.complete) for r in rows] == [
            (0, 0, 2, True), (1, 3, 0, True), (2, 4, 3, True), (3, 8, 1, False)]
        assert rows[2].head == [3] and rows[3].head == [7]


@pytest.mark.parametrize("doc_id", [None, 0, 1, -1, 2**63 - 1, -(2**63)])
def test_ids_as_digits(doc_id):
    assert token_files.id_of(token_files.id_digits(doc_id)) == doc_id


# --- decontamination ---------------------------------------------------------

def test_passages_with_replaced_words_are_found(spark, empty):
    passage = words(30, 500).split()
    changed = [*passage]
    changed[6] = changed[21] = "other"
    spread = [w if i % 3 else "other" for i, w in enumerate(passage)]
    texts = [words(40), words(20) + " " + " ".join(passage).upper() + "!", " ".join(changed) + " " + words(9), " ".join(spread),
             " ".join(passage[:12]) + " " + words(9)]
    items = spark.createDataFrame([(7, " ".join(passage)), (8, None), (9, "too short"), (7, " ".join(passage))], "item_id long, text string")
    docs = docs_of(spark, texts)
    found = decontaminate.overlaps(docs, items).collect()
    assert sorted((r.id, r.item_id, r.matched_words) for r in found) == [(1, 7, 13), (2, 7, 13), (4, 7, 12)]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert decontaminate.overlaps(docs, items.limit(0)).count() == 0
    assert decontaminate.overlaps(empty, items).count() == 0


def test_all_windows_and_short_items_are_found(spark):
    """Each choice of words that may differ, of items of 1 to 15 words, also where the document ends within the item."""
    texts, items, want = [], [], set()
    for n in (*range(1, 15), 15):
        item = [f"i{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        may = 2 * min(n, 13) // 13
        for bad in [()] + [b for m in range(1, may + 2) for b in combinations(range(min(n, 13)), m)]:
            if len(bad) > may and bad != tuple(range(may + 1)):
                continue                                  # one text that differs too much
            changed = [f"z{i}" if i in bad else w for i, w in enumerate(item[:13])]
            if len(bad) <= may:
                want.add((len(texts), n, min(n, 13), min(n, 13) - len(bad)))
            texts.append(" ".join(["a", "b", *changed, "c"]))
        if may:
            want.add((len(texts), n, min(n, 13), min(n, 13) - may))
            texts.append(" ".join(item[:min(n, 13) - may]))
            want.add((len(texts), n, min(n, 13), min(n, 13) - may))
            texts.append(" ".join(item[n - min(n, 13) + may:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.id, r.item_id, r.window_words, r.matched_words) for r in found} == want


# --- line dedup --------------------------------------------------------------

def lines_left(texts, least=50):
    """Texts without any line that is in a run of ``least`` words which also stands earlier, all pairs of runs tried."""
    full = [[(n, x.strip(" \t\r\f\x0b")) for n, x in enumerate(t.split("\n")) if x.strip(" \t\r\f\x0b")] for t in texts]
    every = [(d, k) for d, lines in enumerate(full) for k in range(len(lines))]
    out = []
    for d, lines in enumerate(full):
        gone = set()
        for k in range(len(lines)):
            for e, j in every:
                if (e, j) >= (d, k):
                    break
                run, n = 0, 0
                while k + run < len(lines) and j + run < len(full[e]) and lines[k + run][1] == full[e][j + run][1]:
                    n += len(re.split(r"[ \t]+", lines[k + run][1]))
                    run += 1
                if n >= least:
                    gone |= {lines[i][0] for i in range(k, k + run)}
        out.append("\n".join(s for n, s in enumerate(texts[d].split("\n")) if n not in gone))
    return out


def test_the_end_of_a_run_first_seen_elsewhere_goes(spark):
    """The first line stands alone in an earlier document than the whole run."""
    a, b = words(60), words(45, 500)
    docs = spark.createDataFrame([(1, a), (2, f"{a}\n{b}"), (3, f"{a}\n{b}"), (4, b)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: a, 2: b, 3: "", 4: b}


def test_later_runs_of_lines_go(spark, empty):
    rng = np.random.default_rng(3)
    pool = [words(int(n), 1000 * i) for i, n in enumerate(rng.integers(1, 40, 12))] + ["", "  ", words(63, 77)]
    texts = ["\n".join(pool[i] for i in rng.integers(0, len(pool), rng.integers(1, 14))) for _ in range(40)]
    texts += ["\n".join(["same line here"] * 60), pool[-1], "x\n" + pool[-1] + " \ny"]
    docs = docs_of(spark, texts)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "lines_deleted"] and got.count() == docs.count()
    by_id = {r.doc_id: r.text for r in got.collect()}
    assert [by_id[i] for i in range(len(texts))] == lines_left(texts)
    assert by_id[900] is None and by_id[902] == "twice"
    assert line_dedup.dedup_lines(empty).count() == 0


# --- toxicity and language model ----------------------------------------------

def test_toxic_words_are_learned(spark, empty):
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(300):
        found = ["w" + "".join("abcdefghij"[int(d)] for d in f"{n:03d}") for n in rng.integers(0, 400, 60)]
        if i % 5 == 0:
            found[10:12] = [["vile", "nasty", "awful"][i % 3], "vile"]
        texts.append(" ".join(found))
        labels.append((i, int(i % 10 != 0), int(i % 5 == 0)))
    table = spark.createDataFrame(labels[:200] + [(201, None, 1), (None, 1, 1), (5000, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, texts)
    model = toxicity.fit(docs, table)
    assert model.thresholds == sorted(model.thresholds)
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(rows[i].rejected == (i % 5 == 0) for i in range(202, 300)) >= 95
    assert not rows[900].rejected and rows[0].expected_severity > rows[0].toxic_probability
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not rows[r.doc_id].rejected for r in docs.collect())
    blank = toxicity.fit(docs, table.limit(0))
    assert not blank.weights and toxicity.score(empty, blank).count() == 0


def test_scores_against_counting(spark, empty):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["The", "cat", "hund", "sat", "é", f"r{i}"], 30)) for i in range(60)]
    docs = docs_of(spark, texts)
    rows = language_model.score(docs, table_words=4).collect()   # most words are joined
    own = [(r.doc_id, r.text) for r in docs.collect()]
    counts, held = Counter(), lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    for d, t in own:
        if not held(d):
            counts.update([*(t or "").lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(d), len((t or "").split()) + 1, sum(counts[w] > 0 for w in [*(t or "").lower().split(), None]),
                   round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in [*(t or "").lower().split(), None]), 6)) for d, t in own)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert all(r.train_tokens == n and r.held_out == held(r.doc_id) for r in rows)
    assert language_model.score(empty).count() == 0


def test_probabilities_are_normalised():
    cells = np.arange(0, 5000, 7)
    log_p = language_model.train(cells, np.ones(len(cells), np.int64), steps=5)
    assert np.allclose((10.0 ** log_p.astype(float)).sum(1), 1, atol=1e-4)


# --- workers that cannot import the package ------------------------------------

def test_workers_need_no_package(tmp_path):
    """In a session of its own, started elsewhere; only the driver's process can import the package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
seen = spark.range(1).mapInArrow(
    lambda batches: (b for b in batches if __import__("importlib").util.find_spec("taxaloom") is None), "id long").count()
assert seen == 1, "workers can import the package"
sys.path.insert(0, {root!r})
from taxaloom.llm import bpe, simhash, toxicity
docs = spark.createDataFrame([(1, "some text"), (2, "Some text"), (3, None)], "doc_id long, text string")
assert bpe.decode(bpe.encode(docs, {VOCABULARY!r}), {VOCABULARY!r}).filter("text <> ''").count() == 2
assert sorted(r.component_id for r in simhash.near_duplicates(docs).collect()) == [1, 1, 3]
assert toxicity.keep_clean(docs, toxicity.Model({{"text": 9.0}}, [3.0, 4.0])).count() == 1
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr[-2000:]
