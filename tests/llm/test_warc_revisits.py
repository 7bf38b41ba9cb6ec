import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import oracle, queries, warc_revisits
from oracle.compare import compare, connect

SF = "/root/testdata/sf0.001"
SCHEMA = "record_id long, url string, captured long, kind string, etag string, last_modified string, headers array<struct<name:string,value:string>>, payload_digest string, canonical string"


@pytest.mark.parametrize(("url", "canonical"), [
    ("HTTP://Www.Example.org:80", "www.example.org/"), ("https://a.b/c?z=1&a=2&utm_source=x#top", "a.b/c?a=2&z=1"), ("a.b:443/C/", "a.b/C/"),
    ("http://a.b?ref=q", "a.b/"), ("http://a.b/#x?y", "a.b/"), ("", ""), ("http://", ""), (None, None)])
def test_canonical_url(spark, url, canonical):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(warc_revisits.canonical_url(F.col("url"))).first()[0] == canonical


def expected(rows):
    key = lambda r: (r[2] is not None, r[2] or 0, r[3] == "revisit", r[0] is not None, r[0] or 0)
    out = []
    for r in rows:
        if r[3] != "revisit":
            continue
        earlier = [x for x in rows if x[3] == "response" and x[1] == r[1] and key(x) < key(r)]
        full = max(earlier, key=key) if earlier and r[1] else None
        if not r[1]:
            status = "no_url"
        elif not full:
            status = "no_response"
        elif r[4] is not None and full[4] is not None:
            status = "resolved" if r[4].removeprefix("W/") == full[4].removeprefix("W/") else "mismatch"
        elif r[5] is not None and full[5] is not None:
            status = "resolved" if r[5] == full[5] else "mismatch"
        else:
            status = "no_validator"
        out.append((r[0], status, full and full[0], full[7] if status == "resolved" else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [False, True])
def test_as_of_equals_scanning_all_records(spark, hot):
    rnd = random.Random(hot)
    rows = []
    for i in range(500):
        url = "h.example/" if hot and rnd.random() < 0.6 else rnd.choice(["a.b/x", "a.b/y", "c.d/", None, ""])
        revisit = rnd.random() < (0.97 if hot else 0.6)
        rows.append((i, url and f"http://{url}", rnd.choice([None, rnd.randrange(60)]) if i % 9 == 0 else rnd.randrange(60), "revisit" if revisit else "response",
                     rnd.choice([None, '"1"', 'W/"1"', '"2"']), rnd.choice([None, "d1", "d2"]), None, None if revisit else f"p{i}", "clash"))
    rows.append(rows[3])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    rows = [(r[0], r[1] if r[1] and r[1] != "http://" else None, *r[2:]) for r in rows]
    made = warc_revisits.resolve(df).collect()
    assert sorted(((r.record_id, r.status, r.response_id, r.payload_digest) for r in made), key=str) == expected(rows)


def test_headers_are_merged_by_permission(spark):
    pair = lambda **k: [(n.replace("_", "-"), v) for n, v in k.items()]
    rows = [(1, "http://a.b/", 1, "response", "x", None, pair(Content_Length="9", Date="old", X_A="1") + [(None, "odd")], "p", None),
            (2, "http://a.b/", 2, "revisit", "x", None, pair(content_length="0", DATE="new", Expires="later") + [("Expires", "too")], None, None),
            (3, "http://a.b/", 3, "revisit", "x", None, None, None, None)]
    made = {r.record_id: [tuple(h) for h in r.headers] for r in warc_revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert made[2] == [("Content-Length", "9"), ("X-A", "1"), (None, "odd"), ("DATE", "new"), ("Expires", "later"), ("Expires", "too")]
    assert made[3] == [("Content-Length", "9"), ("Date", "old"), ("X-A", "1"), (None, "odd")]


def test_empty_table(spark):
    assert warc_revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_duckdb(spark):
    out = compare(spark, connect(SF), SF, "op10", queries.op10_warc_revisits, oracle.SQL["op10_warc_revisits"])
    assert out.ok, out.detail
    assert {r.status for r in queries.op10_warc_revisits(spark, SF).select("status").distinct().collect()} >= {"resolved", "mismatch", "no_response", "no_validator"}
