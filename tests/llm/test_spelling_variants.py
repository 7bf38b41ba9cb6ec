import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import queries, spelling_variants

SF = "/root/testdata/sf0.001"


def edits(word, letters):
    """All texts one insertion, deletion or replacement away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return out - {word}


def counts(rows, dropout, least=7):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if dropout and h % dropout == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += len(run) >= least
    return {w: n for w, n in seen.items() if n >= 2}


def expected(words, factor=10):
    letters = {c for w in words for c in w}
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_counts_equal_plain_counting(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdéÉ×ÿAZ") for _ in range(rnd.randint(5, 12))) for _ in range(60)]
    rows = [(rnd.choice([1, 2, 3, None, i]), " ".join(rnd.choices(base, k=30)) + rnd.choice(["", "ß1", "İabcdefg", "_Ābcdefgh"])) for i in range(80)]
    rows += [(5, None), (6, ""), (7, "x" * 70_000), (8, "x" * 70_000), (9, "same words again") , (9, "same words again")]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, n int, word string").repartition(4)
    for dropout in (0, 3, 31):
        assert dict(map(tuple, spelling_variants.word_counts(df, dropout=dropout).collect())) == counts(rows, dropout)


@pytest.mark.parametrize(("classes", "tile"), [(1, 2048), (6, 2048), (6, 5), (3, 40), (1, 7)])
def test_pairs_and_forms_equal_brute_force(spark, classes, tile):
    """Whole words, tiled cells and a hot block: a third of the words are arrangements of the same letters."""
    rnd = random.Random(classes * 100 + tile)
    words = {"".join(rnd.choice("abcÀ×") for _ in range(rnd.randint(7, 9))): rnd.choice([2, 3, 20, 25, 300, 5000]) for _ in range(250)}
    while len(words) < 380:
        words["".join(rnd.sample("aabbccdd", 8))] = rnd.choice([2, 20, 200])
    for w in list(words)[:30]:
        for x in rnd.sample(sorted(edits(w, "abz")), 3):
            words.setdefault(x, 2)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = expected(words)
    assert got(spelling_variants.variants(df, classes=classes, tile=tile)) == want
    pairs = [tuple(r) for r in spelling_variants.near_pairs(df, classes, tile).select("word", "near").collect()]
    assert len(pairs) == len(set(pairs)) == sum(r[4] for r in want)


def test_chains_ties_and_long_words(spark):
    long = "ab" * 3000
    words = {"wordwor": 2, "wordword": 20, "wordwords": 200, "wordwordsx": 2000, "wordwordsxy": 20000, "wordwordsxyz": 200000, "wordwordsxyzz": 2 * 10**6,
             "tietietie": 5, "tietietia": 50, "tietietib": 50, long: 2, long + "c": 20, long[:-1]: 30, "abcdefgh": 2, "hgfedcba": 40, "abcdefhg": 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = expected(words)
    assert got(spelling_variants.variants(df)) == want
    roots = {r[0]: r[2] for r in want}
    assert roots["wordwor"] == "wordwordsxyzz" and roots["tietietie"] == "tietietia" and roots["abcdefgh"] == "abcdefgh"


def test_a_hot_block_is_many_cells(spark):
    """No cell has more than about a tile of members or of those that meet them, though all words share one block."""
    rnd = random.Random(5)
    words = {"".join(rnd.sample("aabbccddeeff", 12)) for _ in range(1500)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    rows = spelling_variants.cells(df, tile=100).where("tile_col >= 0").groupBy("block", "tile_row", "tile_col", "kind").count().collect()
    assert rows and max(r["count"] for r in rows) <= 200
    want = expected({w: 2 for w in words})
    assert got(spelling_variants.variants(df, tile=100)) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.variants(spelling_variants.word_counts(none, dropout=31)).count() == 0
    short = spark.createDataFrame([(1, "only short words"), (2, None)], "doc_id long, text string")
    assert spelling_variants.variants(spelling_variants.word_counts(short)).count() == 0


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op13_spelling_variants(spark, SF)) == expected(counts(rows, 31))
