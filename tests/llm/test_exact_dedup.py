import hashlib
import random
from collections import Counter

import pytest

from ledgerline.llm import exact_dedup, oracle, queries
from oracle.compare import compare, connect
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def expected(rows):
    """(doc_id, keep_id, size, sha) of each row, and the rows kept, by comparing whole texts."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(brute.plain(text), []).append((-len(text or ""), doc_id is None, doc_id))
    best = {body: min(g, key=lambda r: (r[0], r[1], r[2] or 0)) for body, g in groups.items()}
    out = []
    for doc_id, text in rows:
        body = brute.plain(text)
        out.append((doc_id, best[body][2], len(groups[body]), hashlib.sha256(body.encode()).hexdigest()))
    return Counter(out), Counter((best[b][2], hashlib.sha256(b.encode()).hexdigest()) for b in groups)


CASES = [(1, "a b"), (2, "ab"), (3, " a  b "), (4, None), (5, ""), (6, " \n\t\x0b\x0c\r"), (7, "a b"), (8, "é" * 40),
         (8, "é" * 40), (9, "é" * 39), (None, "ab "), (None, "zz"), (None, "zz"), (10, "x" * 1000), (11, "x" * 500 + " " + "x" * 500),
         (12, "x" * 999 + "y"), (13, "x" * 999), (14, "y" + "x" * 999)]


@pytest.mark.parametrize("block_bytes", [1, 3, 64, 4096])
def test_equals_whole_text_comparison(spark, block_bytes):
    rnd = random.Random(block_bytes)
    rows = CASES + [(100 + i, "".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 9)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    made = exact_dedup.groups(df, block_bytes=block_bytes).collect()
    want, kept = expected(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in made) == want
    assert Counter((r.doc_id, r.text_sha256) for r in made if r.kept) == kept


def test_hot_group_long_texts_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BATCH_ROWS", 7)
    rows = [(i, "same text " * 900) for i in range(200)] + [(1000 + i, "same text " * 899 + str(i % 50)) for i in range(100)]
    made = exact_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=64).collect()
    want, kept = expected(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in made) == want
    assert Counter((r.doc_id, r.text_sha256) for r in made if r.kept) == kept


def test_keep_first_returns_whole_rows_once(spark):
    rows = [(i, t, f"n{k}", "x") for k, (i, t) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Kept string, __key string")
    made = exact_dedup.keep_first(df)
    assert made.columns == df.columns
    _, kept = expected(CASES)
    got = made.collect()
    assert Counter((r.doc_id, hashlib.sha256(brute.plain(r.text).encode()).hexdigest()) for r in got) == kept
    assert {tuple(r) for r in got} <= set(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.groups(df).count() == 0
    assert exact_dedup.keep_first(df).count() == 0


def test_query_equals_duckdb(spark):
    out = compare(spark, connect(SF), SF, "op5", queries.op5_exact_dedup, oracle.SQL["op5_exact_dedup"])
    assert out.ok, out.detail


def test_names_tell_blocks_apart_whichever_way_they_go(spark):
    values = [bytes([65 + k]) * 3 for k in range(20)]
    rows = [(b, p, values[0] if b % 3 == 0 and p == 0 else values[(b * 5 + p) % 20]) for b in range(400) for p in range(2)]
    blocks = spark.createDataFrame(rows, "batch_id long, place int, block binary")
    for heavy_max in (0, 3, 1000):  # no block is heavy, one that a third of the batches holds, every one
        light, heavy = exact_dedup._by_weight(blocks, heavy_max)
        dealt = Counter(bytes(r.block) for r in light.collect())
        assert dealt + Counter(bytes(r.block) for r in heavy.collect()) == Counter(v for _, _, v in rows)
        assert not dealt or heavy_max < 1000
        if heavy_max == 3:
            assert max(dealt.values()) * 3 < len(rows)
        named = {(r.batch_id, r.place): r.name for r in exact_dedup._names(blocks, heavy_max).collect()}
        assert len(named) == len(rows) and -1 not in named.values()
        assert len({(named[b, p], v) for b, p, v in rows}) == len(set(named.values())) == len({v for *_, v in rows})


def test_a_null_id_of_a_third_of_the_rows(spark, monkeypatch):
    """Null ids, an id of many texts and one of repeated rows: by broadcast of all ids that come again, and without it."""
    from ledgerline.llm import common

    rows = [(None, f"text {i % 60}") for i in range(90)] + [(7, f"other {i}") for i in range(40)] + [(8, "same")] * 40 + [(100 + i, f"text {i}") for i in range(80)]
    rows += [(300 + i // 2, f"pair {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    _, kept = expected(rows)
    for most in (common.BROADCAST_ROWS_MAX, 1):
        monkeypatch.setattr(common, "BROADCAST_ROWS_MAX", most)
        for heavy in (1000, 5, 1):
            monkeypatch.setattr(common, "HEAVY_MAX", heavy)
            made = exact_dedup.keep_first(df).collect()
            assert Counter((r.doc_id, hashlib.sha256(brute.plain(r.text).encode()).hexdigest()) for r in made) == kept, (most, heavy)
