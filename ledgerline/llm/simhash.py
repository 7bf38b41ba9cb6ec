"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the XXH64 values of the word shingles. For radius r, bit i
gets a non-zero vector a(i) of r + 1 bits, and each non-zero vector v of r + 1 bits gives the mask of the bits
with an odd number of ones in a(i) & v. Any r differing bits leave a v orthogonal to all their vectors
(r equations, r + 1 unknowns), so any two fingerprints within r bits agree under some mask: every
link is found, none by chance. For r = 3 there are 15 masks of about 34 of the 64 bits.

Only distinct fingerprints are bucketed. A bucket of at most ``bucket_max`` is searched whole by a breadth-first
walk that emits one link for each fingerprint it reaches (a spanning forest, not all pairs). A larger bucket
is split by the same construction over the bits its mask leaves out, again without losing a link; a bucket
whose fingerprints differ in fewer than 2^r bits (so at most 128 for r = 3) is always searched whole, which ends this.
Components of the forest are components of all links. Radii up to 4.

Null text counts as empty; a text without words has fingerprint zero and links like any other. Repeated
rows share their fingerprint and component. doc_id null is never the smallest; a component of null ids
has a null id. An empty table gives an empty result. Very long texts are read in pieces of ``PIECE`` bytes. Further
columns, whatever their names, play no part in ``near_groups`` and stay in ``keep_smallest``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import keep_decided, map_batches, own_worker, salted_join, stored
from ledgerline.llm.components import components

PIECE = 1 << 20
BUCKET_MAX = 8192
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text in UTF-8."""
    ones, n, before, at = np.zeros(64, np.int64), 0, [], 0
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        cut = _BLANK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        got = before + text[at:end].lower().split()
        at = end
        if len(got) < words:
            before = got
            continue
        joined = b" ".join(got)
        ends = np.cumsum([len(w) + 1 for w in got])
        starts = [0, *ends[: len(got) - words].tolist()]
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        before = got[len(got) - words + 1 :] if words > 1 else []
    if not n and before:
        return digest(b" ".join(before), seed)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(docs: DataFrame, words: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp: the fingerprint's bits as a long) per row."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("simhash")
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return map_batches(source, run, source.select("doc_id").schema.add("fp", "long"))


def masks(radius: int, bits: list[int]) -> list[int]:
    """2^(radius+1) - 1 masks over the bit positions ``bits``, of which one misses any ``radius`` given positions."""
    full = (1 << (radius + 1)) - 1
    return [sum(1 << b for k, b in enumerate(bits) if (1 + k % full & v).bit_count() % 2) for v in range(1, full + 1)]


@lru_cache(8192)
def bucket_mask(radius: int, path: int) -> int:
    """Bits that the fingerprints of a bucket share: the mask picked at each step of ``path``, joined."""
    steps, base = [], 1 << (radius + 1)
    while path:
        path, step = divmod(path, base)
        steps.append(step)
    shared = 0
    for step in reversed(steps):
        shared |= masks(radius, [b for b in range(64) if not shared >> b & 1])[step - 1]
    return shared


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    links, rest = [], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            if near.any():
                links += [(int(here), int(x)) for x in rest[near]]
                queue.extend(rest[near])
                rest = rest[~near]
    return links


def _link(radius: int, bucket_max: int):
    """Rows sorted by (path, key): links (path 0) of small buckets, finer rows (path, key, a) of large ones."""
    base = 1 << (radius + 1)

    def finer(path: int, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        shared = bucket_mask(radius, path)
        for step, mask in enumerate(masks(radius, [b for b in range(64) if not shared >> b & 1]), 1):
            key = fps & np.uint64(shared | mask)
            n = len(fps)
            yield out(np.full(n, path * base + step, np.int64), key.view(np.int64), fps.view(np.int64), np.zeros(n, np.int64))

    def out(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("simhash")
        open_at, held, large = None, np.empty(0, np.uint64), False  # the bucket at the end of the last batch

        def close() -> Iterator[pa.RecordBatch]:
            if not large and len(held) > 1 and (links := _forest(held, radius)):
                a, b = np.array(links, np.uint64).view(np.int64).T
                yield out(np.zeros(len(links), np.int64), np.zeros(len(links), np.int64), a.copy(), b.copy())

        for batch in batches:
            if not batch.num_rows:
                continue
            path, key, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            fp = fp.view(np.uint64) if fp.dtype == np.int64 else fp.astype(np.int64).view(np.uint64)
            starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (key[1:] != key[:-1])])
            ends = np.r_[starts[1:], len(path)]
            if open_at != (path[0], key[0]):
                yield from close()
                held, large = np.empty(0, np.uint64), False
            two = (ends - starts == 2) & (starts > 0) & (ends < len(path))  # whole buckets of two, all at once
            a, b = fp[starts[two]], fp[starts[two] + 1]
            near = np.bitwise_count(a ^ b) <= radius
            if near.any():
                zero = np.zeros(int(near.sum()), np.int64)
                yield out(zero, zero, a[near].view(np.int64), b[near].view(np.int64))
            for s, e in zip(starts[~two], ends[~two], strict=True):
                if e - s == 1 and s > 0 and e < len(path):
                    continue
                if s > 0:
                    if s != starts[0]:
                        yield from close()
                    held, large = np.empty(0, np.uint64), False
                if large:
                    yield from finer(int(path[s]), fp[s:e].copy())
                    continue
                held = np.concatenate([held, fp[s:e]])
                if len(held) > bucket_max and 64 - bucket_mask(radius, int(path[s])).bit_count() >= 1 << radius:
                    yield from finer(int(path[s]), held)
                    held, large = np.empty(0, np.uint64), True
            open_at = (path[-1], key[-1])
        yield from close()

    return run


def links(fps: DataFrame, radius: int, bucket_max: int = BUCKET_MAX) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that span all pairs within ``radius`` bits."""
    if not 0 <= radius <= 4:
        raise ValueError("radius: 0 to 4 bits")
    first = [F.struct(F.lit(v).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
             for v, m in enumerate(masks(radius, list(range(64))), 1)]
    rows = fps.select("fp", F.explode(F.array(*first)).alias("at")).select("at.path", "at.key", "fp")
    parts, found = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), []
    while True:
        dealt = rows.repartition(parts, "path", "key").sortWithinPartitions("path", "key")
        step = stored(map_batches(dealt, _link(radius, bucket_max), "path long, key long, a long, b long"), "links")
        found.append(step.where("path = 0").select("a", "b"))
        rows = step.where("path > 0").select("path", "key", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_groups(docs: DataFrame, words: int, radius: int, text_col: str = "text", id_col: str = "doc_id", bucket_max: int = BUCKET_MAX) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), fp, root, first_fp."""
    marked = stored(fingerprints(docs, words, text_col, id_col), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "classes")
    reach = components(links(classes.select("fp"), radius, bucket_max)).withColumnsRenamed({"node": "fp"})
    joined = classes.join(reach, "fp", "left").where("root is not null or n > 1").withColumn("root", F.coalesce("root", "fp"))
    best = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("best"))
    of_class = salted_join(joined.select("fp", "root"), best.select("root", "component_id", F.col("best.fp").alias("first_fp")), ["root"], "fp")
    out = salted_join(marked, of_class, ["fp"], F.monotonically_increasing_id(), "left")  # of a table, so a row's number stays; ids may be null
    alone = F.col("root").isNull()
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("first_fp", "fp").alias("first_fp"),
        "fp",
    )


def keep_smallest(docs: DataFrame, words: int, radius: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each component stays, with all columns: smallest doc_id (null last), then smallest fingerprint.

    Rows of one doc_id are told apart by their fingerprint; repeated rows among them are one.
    """

    def tag(rows: DataFrame, name: str) -> DataFrame:
        columns = [f"`{c}`" for c in rows.columns]
        source = rows.select(*columns, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias(name))
        schema = rows.schema.add(name, "string")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fps = pa.array([f"{fingerprint(t.as_py(), words):016x}" for t in batch.column(batch.num_columns - 1)], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], schema.names)

        return map_batches(source, run, schema)

    decided = near_groups(docs, words, radius, text_col, id_col)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("first_fp"))
    return keep_decided(docs, decided.select("doc_id", F.col("fingerprint").alias("tag"), kept.alias("kept")), id_col, tag)
