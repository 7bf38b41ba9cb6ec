import hashlib
import math
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import mixing, oracle, queries
from oracle.compare import compare, connect
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def expected(rows, weights=(1, 2, 3), most=3, seed=17):
    size = [len(brute.WORD.findall(t or "")) for _, t, _ in rows]
    per = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(per.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        share = (total - sum(most * per[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        above = {s for s in rest if weight[s] * share > most * per[s]}
        if not above:
            break
        full |= above
    target = {s: float(most * per[s]) if s in full else weight[s] * share for s in order}
    out = []
    for (i, _, s), n in zip(rows, size, strict=True):
        rate = min(target[s] / per[s], most) if per[s] else 0
        u = int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:12], 16) / 16**12
        copies = math.floor(rate) + (u < rate - math.floor(rate))
        out.append((i, n, per[s], round(target[s], 6), n * copies, copies))
    return out


CASES = [(i, "w " * (i % 7), f"s{i % 5}") for i in range(200)] + [
    (None, "a b", None), (300, None, "empty"), (301, "x", ""), (302, "é\x0bü\n z", "é"), (302, "é\x0bü\n z", "é"), (303, "big " * 900, "S"), (304, " \n", None)]


def test_equals_plain_water_filling(spark):
    df = spark.createDataFrame(CASES, "doc_id long, text string, source string").repartition(4)
    made = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken, r.copies) for r in mixing.plan(df).collect()]
    assert Counter(made) == Counter(expected(CASES))


@pytest.mark.parametrize("broadcast_max", [0, 100000])
def test_mix_emits_whole_rows_as_often_as_planned(spark, monkeypatch, broadcast_max):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS_MAX", broadcast_max)
    rows = [(i, t, s, "x", k) for k, (i, t, s) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, Rate string, __size long")
    made = mixing.mix(df)
    assert made.columns == df.columns
    want = Counter({row: e[-1] for row, e in zip(rows, expected(CASES), strict=True) if e[-1]})
    assert Counter(tuple(r) for r in made.collect()) == want
    assert Counter(tuple(r) for r in mixing.mix(df.repartition(7)).collect()) == want


def test_hot_source_comes_near_its_target(spark):
    rows = [(i, "some words here " * (1 + i % 9), "hot" if i % 3 else f"s{i % 11}") for i in range(3000)]
    made = mixing.plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    made["source"] = made.doc_id.map({i: s for i, _, s in rows})
    per = made.groupby("source").agg({"taken": "sum", "target": "first"})
    assert ((per.taken - per.target).abs() <= 0.15 * per.target).all()
    assert abs(made.groupby("source").target.first().sum() - made["size"].sum()) < 1e-6


def test_all_words_empty_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in mixing.plan(df).collect()) == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]
    assert mixing.plan(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0 and mixing.mix(df).count() == 0


def test_query_equals_duckdb(spark):
    out = compare(spark, connect(SF), SF, "op8", queries.op8_mixing, oracle.SQL["op8_mixing"])
    assert out.ok, out.detail
