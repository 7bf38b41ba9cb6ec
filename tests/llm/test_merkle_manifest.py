import hashlib
import random
import zlib

import pytest

from ledgerline.llm import merkle_manifest, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tampered(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3 or row[4] is None:
        return row
    return (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))


def tree(digests, fan):
    """Levels from the leaves to one node."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def walk(levels, at, own, fan):
    """Siblings on the way up, and what ``own`` folds to."""
    found = []
    for level in levels[:-1]:
        run = level[at // fan * fan : at // fan * fan + fan]
        found += run[: at % fan] + run[at % fan + 1 :]
        own = H(*run[: at % fan], own, *run[at % fan + 1 :])
        at //= fan
    return found, own


def expected(rows, fan=8):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]], fan) for g in names}
    top = tree([trees[g][-1][0] for g in names], fan)
    out = []
    for k, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            low, own = walk(trees[g], at, leaf(tampered(row)), fan)
            high, own = walk(top, k, own, fan)
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, H(*low, *high), own, own == root))
    return sorted(out, key=repr)


def check(spark, rows, fan=8, **more):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    made = merkle_manifest.verify(df, merkle_manifest.lower_third, fan=fan)
    assert sorted(map(tuple, made.collect()), key=repr) == expected(rows, fan)


CASES = [(1, "s", "en", 3, "Abc"), (2, None, "en", None, None), (3, "", "en", 0, ""), (None, "s", "en", 1, "A"), (None, "s", "en", 1, "B"),
         (5, "s", None, 1, "X"), (6, "s", "", 1, "Y"), (7, "é", "é", 1, "É" * 5000 + "A"), (8, "s", "en", 3, "same"), (8, "s", "en", 3, "same"), (-9, "s", "zz", 2, "A:1-")]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 64, 65, 600])
def test_equals_plain_trees(spark, n):
    rnd = random.Random(n)
    rows = CASES + [(100 + i, "s", "en" if i % 3 else rnd.choice(["de", "fr", None]), i, rnd.choice(["Aa", "bb"]) * i) for i in range(n)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[(1, "s", "en", 1, "A")], [(1, "s", None, 1, None)] * 2, [(i, "s", "en", 1, "A") for i in range(9)], [(i, "s", str(i), 1, "A") for i in range(20)]])
def test_single_groups_and_lone_leaves(spark, rows):
    check(spark, rows)


def test_other_fans_and_clashing_columns(spark):
    rows = CASES + [(i, "s", "en", 1, "T") for i in range(40)]
    check(spark, rows, fan=3)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, at int, run int, `group` int")
    made = merkle_manifest.verify(df, merkle_manifest.lower_third)
    assert sorted(map(tuple, made.collect()), key=repr) == expected(rows)


def test_other_change_is_found_and_no_change_verifies(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "T") for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    assert all(r.verified for r in merkle_manifest.verify(df).collect())
    from pyspark.sql import functions as F

    made = merkle_manifest.verify(df, lambda f: f | {"n_chars": F.when(f["doc_id"] == 3, F.lit(9)).otherwise(f["n_chars"])}).collect()
    assert [r.doc_id for r in made if not r.verified] == [3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    made = merkle_manifest.verify(df, merkle_manifest.lower_third)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and made.count() == 0


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()]
    made = queries.op12_merkle_manifest(spark, SF).collect()
    assert sorted(map(tuple, made), key=repr) == expected(rows)
    assert any(r.verified for r in made) and not all(r.verified for r in made)


def test_more_rows_than_the_limit_of_recursive_queries(spark):
    """Spark's default limit of rows is lifted for the climb alone."""
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        check(spark, [(i, "s", "en", 1, "T") for i in range(700)])
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "50"
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
