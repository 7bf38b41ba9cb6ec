from collections import Counter

import pytest

from ledgerline.llm import license_scan, queries

SF = "/root/testdata/sf0.01"
LINES = {  # the notices that the test tables hold, each a line of its own
    "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache",
    "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "reserved",
}


@pytest.fixture(scope="module")
def classifier(spark):
    return license_scan.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_query_finds_each_notice_and_no_other(spark):
    query = queries.op3_license_scan(spark, SF)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
    made = {r.doc_id: r for r in query.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(made) == len(docs)
    for d in docs:
        lines = (d.text or "").split("\n")
        want = [f"{i}:{LINES[x]}" for i, x in enumerate(lines) if x in LINES]
        assert made[d.doc_id].found == ",".join(want)
        assert made[d.doc_id].licenses == ",".join(sorted({w.split(":")[1] for w in want}))
        assert made[d.doc_id].n_paragraphs == sum(any(c.isalnum() for c in x) for x in lines)


def test_variants_families_and_unlike_paragraphs(spark, classifier):
    known = {
        "This project is licensed under the Apache License, Version 2.0 and may be used accordingly.": "apache",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
        "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation": "lgpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl",
        "LICENSED UNDER CC BY-SA 4.0.": "cc-by-sa",
    }
    unlike = ["His driving license was granted in version two of the story.", "They reserved all seats on the right.", "The public library in general.",
              "MIT is a university; the Apache are a people.", "word " * 400, "日本語の文章です。", "license", "Copyright"]
    rows = [(i, t, None) for i, t in enumerate([*known, *unlike])]
    made = {r.doc_id: r.licenses for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string"), classifier).collect()}
    assert [made[i] for i in range(len(known))] == list(known.values())
    assert [made[i] for i in range(len(known), len(rows))] == [""] * len(unlike)


def test_nulls_repeated_rows_and_empty_tables(spark, classifier):
    notice = "a\n\n  \nReleased under the MIT License.\nAll rights reserved."
    rows = [(1, notice, 1), (1, notice, 2), (None, None, 3), (2, "", 4), (None, "\n\n", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, line long")
    made = Counter((r.doc_id, r.n_paragraphs, r.licenses, r.found) for r in license_scan.scan(df, classifier).collect())
    assert made == Counter({(1, 3, "mit,reserved", "3:mit,4:reserved"): 2, (None, 0, "", ""): 2, (2, 0, "", ""): 1})
    assert license_scan.scan(df.limit(0), license_scan.train(df.limit(0))).count() == 0
