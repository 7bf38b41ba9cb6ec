import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import quality, queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def brute_base(text):
    text = text or ""
    words = brute.WORD.findall(text)
    lines = [line for line in text.split("\n") if brute.WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + j for i, w in enumerate(windows) if w in often for j in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(hit))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t\x0b#|<日   ")), max_size=120))
def test_base_figures(text):
    assert quality.base(text.encode()) == brute_base(text)


def test_repeats_with_many_distinct_words():
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(30000)}" for _ in range(40000)]
    words[100:140] = words[30000:30040]
    assert quality.repeat_words([w.encode() for w in words]) == brute_base(" ".join(words))[4] >= 80


def test_distance_bounds_and_symmetry():
    p, q = np.array([1.0, 0, 0]), np.array([0, 0.5, 0.5])
    assert quality.js_distance(p, p) == 0 and quality.js_distance(p, q) == pytest.approx(1)
    r = np.array([0.2, 0.3, 0.5])
    assert quality.js_distance(p, r) == pytest.approx(quality.js_distance(r, p))


def brute_references(rows):
    """Median over folds of the shares, by plain counting."""
    import xxhash

    per = {}
    for text, lang in rows:
        text = text or ""
        if not (words := brute.WORD.findall(text)):
            continue
        for name in {lang or "", quality.ALL}:
            fold = per.setdefault((name, xxhash.xxh64_intdigest(text.encode()) % quality.FOLDS), [Counter(), Counter(), 0])
            fold[0].update("aA1 \n.#é"[k] for c in text for k in [int(quality._CLASS[c.encode()[0]])])
            fold[1].update(brute.lower_ascii(w).strip(".,;:!?\"'()") for w in words)
            fold[2] += len(words)
    total = sum(f[2] for (name, _), f in per.items() if name == quality.ALL)
    out = {}
    for name in {n for n, _ in per}:
        folds = [f for (n, _), f in per.items() if n == name]
        if name != quality.ALL and (not name or sum(f[2] for f in folds) < quality.LANGUAGE_SHARE * total):
            continue
        low = lambda values: sorted(values)[len(folds) // 2]
        classes = [low([f[0][c] / sum(f[0].values()) for f in folds]) for c in "aA1 \n.#é"]
        words = {w: low([f[1][w] / f[2] for f in folds]) for w in set().union(*[f[1] for f in folds]) if len(w.encode()) <= quality.WORD_BYTES}
        out[name] = classes, {w.encode(): s for w, s in words.items() if s >= quality.COMMON_SHARE}
    return out


def test_references_equal_plain_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = quality.references(docs)
    want = brute_references([(r.text, r.lang) for r in docs.collect()])
    assert set(made) == set(want)
    for name, (classes, words) in want.items():
        assert made[name].classes == pytest.approx(np.array(classes) / sum(classes))
        assert set(made[name].places) == set(words)
        assert made[name].words[[made[name].places[w] for w in words]] == pytest.approx(np.array(list(words.values())) / max(1, sum(words.values())))


def test_query_equals_brute_force_and_rejects_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    made = {r.doc_id: r for r in queries.op9_quality(spark, SF).collect()}
    refs = quality.references(spark.read.parquet(f"{SF}/documents.parquet"))
    for d in docs:
        r, figures = made[d.doc_id], brute_base(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures
        assert r.base_failed == (figures[0] < 10 or 100 * figures[4] > 20 * figures[0])
        assert r.kept == quality.verdict((d.text or "").encode(), d.lang or "", refs)[-1]
        assert not (r.base_failed and r.kept)


def test_labels_agree(spark):
    sf = "/root/testdata/sf0.01"
    made = queries.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in made if r.quality == 1 and not r.base_failed]
    bad = [r for r in made if r.quality == 0 and r.n_words >= quality.MIN_WORDS]
    assert all(r.kept for r in good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_copies_do_not_move_the_references(spark):
    rnd = random.Random(1)
    clean = [(i, " ".join(rnd.choice(["the", "of", "and", "tree", "house", "river", "walks", "sings."]) for _ in range(200)), "en") for i in range(300)]
    menu = " | ".join(["HOME", "ABOUT", "X9"] * 60)
    df = spark.createDataFrame(clean + [(1000 + i, menu, "en") for i in range(150)], "doc_id long, text string, lang string")
    made = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert all(made[i] for i in range(300)) and not any(made[1000 + i] for i in range(150))


def test_nulls_repeated_rows_clashing_columns_and_empty_tables(spark):
    rows = [(1, None, None, "a"), (None, "", "en", "b"), (2, "word " * 9, "en", "c"), (2, "word " * 9, "en", "c"), (3, "A b c d e f g h i j k", None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, __text string")
    made = sorted(quality.judge(df).select("n_words", "base_failed", "kept").collect())
    assert [tuple(r) for r in made] == [(0, True, False), (0, True, False), (9, True, False), (9, True, False), (11, False, True)]
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == rows[-1:]
    assert quality.judge(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0


def texts_of(words, n, seed, length=60):
    """Texts of 35 % common words, the others from 2,000 made ones."""
    rnd = random.Random(seed)
    made = ["".join(rnd.choices(words[0], k=rnd.randint(4, 9))) for _ in range(2000)]
    pool = made + rnd.choices(words[1], k=len(made) * 35 // 65)
    return [" ".join(rnd.choices(pool, k=length)) for _ in range(n)]


LATIN = ("abcdefghilmnoprstu", ["the", "of", "and", "to", "in", "is", "for", "that"])
CYRILLIC = ("абвгдеиклмнопрсту", ["и", "в", "не", "на", "что", "он", "как", "это"])


@pytest.mark.parametrize("broadcast_max", [0, 100000])
def test_clean_texts_stay_whatever_else_the_table_holds(spark, monkeypatch, broadcast_max):
    monkeypatch.setattr(quality, "BROADCAST_ROWS_MAX", broadcast_max)
    rare, null, junk = texts_of(CYRILLIC, 50, 1), texts_of(CYRILLIC, 50, 2), [" | ".join(f"X{i}{j} #{i * j}" for j in range(60)) for i in range(5)]
    groups = {"en": texts_of(LATIN, 1200, 3, 4000), "ru": rare + junk, None: null, "xx": texts_of(CYRILLIC, 2, 4)}
    rows = [(f"{lang}{i}", t, lang) for lang, texts in groups.items() for i, t in enumerate(texts)]
    assert sum(len(t.split()) for t in groups["ru"]) < quality.LANGUAGE_SHARE * sum(len(t.split()) for _, t, _ in rows)
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(8)
    made = {r.doc_id: r for r in quality.judge(df).collect()}
    assert len(made) == len(rows)
    assert all(made[f"ru{i}"].kept and made[f"ru{i}"].class_distance is not None for i in range(50))
    assert not any(made[f"ru{i}"].kept for i in range(50, 55))
    assert all(made[f"None{i}"].kept for i in range(50)) and made["xx0"].kept and made["xx1"].kept
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in made.items() if r.kept}


@pytest.mark.parametrize("alphabet, word", [("абвгдеиклмнопрсту", "который"), ("가나다라마바사아자차카타파하", "그러나"), ("abcdefghilmnoprstu", "nevertheless")])
def test_common_words_of_any_length_and_script_are_counted(spark, alphabet, word):
    assert len(word.encode()) > 8
    texts = texts_of((alphabet, [word, word[:2]]), 60, 7)
    made = quality.references(spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string").repartition(4))
    want = brute_references([(t, "xx") for t in texts])
    for name in ("xx", quality.ALL):
        assert set(made[name].places) == set(want[name][1])
        assert made[name].words[made[name].places[word.encode()]] > 0.1


def test_counts_are_passed_on_by_number_and_by_bytes(spark, monkeypatch):
    import pyarrow as pa

    texts = [b"a" * 50 + b" %d word" % i for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array(texts, pa.binary())], ["lang", "text"])
    for entries, size in ((10, 1 << 30), (1 << 30, 200)):
        monkeypatch.setattr(quality, "_ENTRIES", entries)
        monkeypatch.setattr(quality, "_BYTES", size)
        out = list(quality._count(iter([batch])))
        sums = Counter()
        for r in pa.Table.from_batches(out).to_pylist():
            sums[r["kind"], r["item"]] += r["n"]
        assert len(out) > 9 and sums[1, b"word"] == sums[1, b"a" * 50] == 40 and sums[2, b""] == 120
