import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from ledgerline.llm import quality
from tests.llm import brute
from tests.llm.test_mixing import expected as mixed
from tests.llm.test_quality import brute_base, brute_references

SF = "/root/testdata/sf0.001"


def brute_quality(rows):
    """Rows that stay, with references by plain counting."""
    refs = {}
    for name, (classes, words) in brute_references([(r["text"], r["lang"]) for r in rows]).items():
        import numpy as np

        common = sorted(words.items())
        shares = np.array([s for _, s in common] + [max(0.0, 1 - sum(s for _, s in common))])
        refs[name] = quality.Reference(np.array(classes) / sum(classes), {w: i for i, (w, _) in enumerate(common)}, shares / shares.sum())
    out = []
    for r in rows:
        figures = brute_base(r["text"])
        if figures[0] >= 10 and 100 * figures[4] <= 20 * figures[0] and quality.verdict((r["text"] or "").encode(), r["lang"] or "", refs)[-1]:
            out.append(r)
    return out


def brute_copies(rows):
    best = {}
    for r in rows:
        key = (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)
        body = brute.plain(r["text"])
        if body not in best or key < best[body][0]:
            best[body] = (key, r)
    return [r for _, r in best.values()]


def brute_near(rows):
    roots = brute.components([r["doc_id"] for r in rows], [brute.fingerprint(r["text"], 3) for r in rows], 3)
    return [r for r, root in zip(rows, roots, strict=True) if r["doc_id"] == root]


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    rows += [r | {"doc_id": 10_000 + r["doc_id"], "text": r["text"] + " end"} for r in rows]  # near copies
    plain = lambda rs: Counter(tuple(r[c] for c in docs.columns) for r in rs)
    frame = spark.createDataFrame(rows, docs.schema)
    for (_, stage), slow in zip(corpus_pipeline.STAGES[:3], (brute_quality, brute_copies, brute_near), strict=True):
        frame, before = stage(spark, frame, SF), len(rows)
        rows = slow(rows)
        assert frame.columns == docs.columns
        assert Counter(map(tuple, frame.collect())) == plain(rows) and 0 < len(rows) < before
        frame = spark.createDataFrame(rows, docs.schema)
    taken = mixed([(r["doc_id"], r["text"], r["source"]) for r in rows])
    rows = [r for r, t in zip(rows, taken, strict=True) for _ in range(t[-1])]
    frame = corpus_pipeline.mix_sources(spark, frame, SF)
    assert frame.columns == docs.columns and Counter(map(tuple, frame.collect())) == plain(rows)
    encoded = corpus_pipeline.encode(spark, frame, SF)
    assert Counter(map(tuple, encoded.collect())) == brute_encode(rows)


def brute_encode(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [library.encode(r["text"] or "") for r in rows]
    return Counter((r["doc_id"], len(i), sha(",".join(map(str, i))), sha(library.decode(i))) for r, i in zip(rows, ids, strict=True))


def test_run_equals_brute_force(spark):
    rows = brute_near(brute_copies(brute_quality([r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])))
    taken = mixed([(r["doc_id"], r["text"], r["source"]) for r in rows])
    rows = [r for r, t in zip(rows, taken, strict=True) for _ in range(t[-1])]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == brute_encode(rows)


def test_an_empty_table_passes_all_stages(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        assert frame.count() == 0
