"""Exact dedup by deterministic block naming.

A text without its ASCII white space is cut into blocks of ``block_bytes``. Sorting the distinct blocks gives each
an integer name; then adjacent pairs of names get names in turn, until each document has one name.
Two documents have equal names and block counts exactly if their texts are equal: no hash is trusted.

How it runs:

1. One pass over the texts gives each row an id, each batch of rows a list of its distinct blocks, and each
   row the places of its blocks in that list. A block that a third of the rows hold is so one row per batch
   before anything is shuffled. Written as a table, because row ids must not change afterwards.
2. The blocks (the only shuffle of text) are dealt by their value, sorted, and numbered within their
   partition; the numbers go back to the batches as integers. A block in one of ``HEAVY_MAX`` rows or more, found by
   a count of hashes, isn't dealt, as all its rows would meet in one task: its value is reduced to one row first, numbered below
   the others, and joined to its rows where they lie. The hash only picks the way; names go by value.
3. Each round pairs neighbours, numbers the distinct pairs in sorted order and joins the numbers back,
   the pairs salted by row. Rounds: the base-2 logarithm of the longest document's blocks.
4. Documents group by (blocks, name); the row with the most code points in the original text, then the
   smallest doc_id (null last), then the smallest row id, stays.

Null text counts as empty; empty and white-space-only texts are equal to each other. Repeated rows (the same
doc_id and text) are separate rows of one group, of which one stays. An empty table gives an empty result. Further columns
don't matter to ``groups``; ``keep_first`` returns them, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import HEAVY_MAX, SALTS, keep_decided, map_batches, own_worker, salted_join, stored

BLANK = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 4096
#: Rows and bytes of text in one batch of step 1 at most (a single longer text is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20

_PASS = "row_id long, batch_id long, doc_id {id}, n_points int, text_sha256 binary, places array<int>, place int, block binary"


def _cut(blocks_of: int):
    """Rows (row_id …, places) of documents and (batch_id, place, block) of blocks, in one stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("exact_dedup")
        base = TaskContext.get().partitionId() << 33
        row_id = batch_no = 0
        ids, points, shas, places, names, held = [], [], [], [], {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, points, shas, places, names, held, row_id, batch_no
            n, m = len(points), len(names)
            none, batch = pa.nulls, base + batch_no
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(base + row_id, base + row_id + n), pa.int64()), pa.array([batch] * n, pa.int64()),
                 pa.array(ids, id_type), pa.array(points, pa.int32()), pa.array(shas, pa.binary()),
                 pa.array(places, pa.list_(pa.int32())), none(n, pa.int32()), none(n, pa.binary())], header)
            for at in range(0, m, 1024):
                part = list(names)[at : at + 1024]
                k = len(part)
                yield pa.RecordBatch.from_arrays(
                    [none(k, pa.int64()), pa.array([batch] * k, pa.int64()), none(k, id_type), none(k, pa.int32()),
                     none(k, pa.binary()), none(k, pa.list_(pa.int32())), pa.array(range(at, at + k), pa.int32()),
                     pa.array(part, pa.binary())], header)
            row_id, batch_no = row_id + n, batch_no + 1
            ids, points, shas, places, names, held = [], [], [], [], {}, 0

        header = ["row_id", "batch_id", "doc_id", "n_points", "text_sha256", "places", "place", "block"]
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, n, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                plain = text.as_py().translate(None, BLANK)
                ids.append(doc_id.as_py())
                points.append(n.as_py())
                shas.append(hashlib.sha256(plain).digest())
                cuts = [plain[i : i + blocks_of] for i in range(0, len(plain), blocks_of)] or [b""]
                places.append([names.setdefault(c, len(names)) for c in cuts])
                held += len(plain)
                if len(points) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield from flush()
        if points:
            yield from flush()

    return run


def _number_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch_id, place, block) sorted by block: the name is the rank of the block in its partition."""
    name, last = TaskContext.get().partitionId() << 33, None
    for batch in batches:
        names = []
        for block in batch.column(2):
            value = block.as_py()
            if value != last:
                name, last = name + 1, value
            names.append(name)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.int64())], ["batch_id", "place", "name"])


def _by_weight(blocks: DataFrame, heavy_max: int) -> tuple[DataFrame, DataFrame]:
    """``blocks`` (batch_id, place, block) parted by the hash of the block: those to be dealt, and the heavy ones."""
    hashed = blocks.select("*", F.xxhash64("block").alias("hash"))
    total = blocks.agg(F.count("place")).first()[0]
    heavy = hashed.groupBy("hash").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") * heavy_max >= total))
    heavy = F.broadcast(stored(heavy.select("hash"), "heavy-blocks"))  # heavy_max rows at most
    return hashed.join(heavy, "hash", "left_anti").drop("hash"), hashed.join(heavy, "hash", "left_semi").drop("hash")


def _names(blocks: DataFrame, heavy_max: int = HEAVY_MAX) -> DataFrame:
    """(batch_id, place, name): equal blocks, and only these, have equal names. No name is -1, which ends a row of an odd length."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light, heavy = _by_weight(blocks, heavy_max)
    names = map_batches(light.repartition(parts, "block").sortWithinPartitions("block"), _number_sorted, "batch_id long, place int, name long")
    values = heavy.select("block", F.pmod("batch_id", F.lit(SALTS)).alias("salt")).distinct().select("block").distinct()
    values = stored(values.sortWithinPartitions("block").select("block", (-2 - F.monotonically_increasing_id()).alias("name")), "heavy-names")
    few = values.count() <= 2 * heavy_max  # more only if many blocks share a hash
    found = heavy.join(F.broadcast(values), "block") if few else salted_join(heavy, values, ["block"], "batch_id")
    return names.unionByName(found.select("batch_id", "place", "name"))


def identities(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: row_id, doc_id, n_points, text_sha256 (binary), n_blocks, name."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.length(text).alias("n_points"), text.cast("binary").alias("text"))
    schema = _PASS.format(id=source.schema["doc_id"].dataType.simpleString())
    cut = stored(map_batches(source, _cut(block_bytes), schema), "blocks")
    rows = cut.where("row_id is not null").select("row_id", "batch_id", "doc_id", "n_points", "text_sha256", "places")
    blocks = cut.where("block is not null").select("batch_id", "place", "block")
    names = _names(blocks)
    cells = (rows.select("row_id", "batch_id", F.size("places").alias("n_blocks"), F.posexplode("places").alias("at", "place"))
             .join(names, ["batch_id", "place"]).select("row_id", "n_blocks", "at", "name"))
    level = stored(cells, "names")
    longest = level.agg(F.max("n_blocks")).first()[0] or 0
    done, width = [level.where("n_blocks = 1").select("row_id", "n_blocks", "name")], 1
    while width < longest:
        pairs = (level.where(F.col("n_blocks") > width)
                 .groupBy("row_id", "n_blocks", F.expr("at div 2").cast("int").alias("at"))
                 .agg(F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                      F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")))
        pairs = pairs.select("row_id", "n_blocks", "at", "left", "right").checkpoint()
        numbers = (pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
                   .withColumn("name", F.monotonically_increasing_id()).checkpoint())
        level = salted_join(pairs, numbers, ["left", "right"], "row_id").select("row_id", "n_blocks", "at", "name")
        width *= 2
        level = level.checkpoint() if width < longest else level
        done.append(level.where((F.col("n_blocks") <= width) & (F.col("n_blocks") > width // 2)).select("row_id", "n_blocks", "name"))
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return rows.select("row_id", "doc_id", "n_points", "text_sha256").join(named, "row_id")


def _first() -> list[Column]:
    return [(-F.col("n_points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row_id")]


def groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (lowercase hex), n_points."""
    named = stored(identities(docs, text_col, id_col, block_bytes), "identities")
    best = (named.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), F.min(F.struct(*_first())).alias("best"))
            .where("group_size > 1")
            .select("n_blocks", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row")))
    out = salted_join(named, best, ["n_blocks", "name"], "row_id", "left")
    alone = F.col("keep_row").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row_id"))).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
        "n_points",
    )


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""

    def tag(rows: DataFrame, name: str) -> DataFrame:
        text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
        plain = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
        return rows.withColumn(name, F.concat_ws(":", F.sha2(plain, 256), F.length(text)))

    decided = groups(docs, text_col, id_col, block_bytes)
    decided = decided.select("doc_id", F.concat_ws(":", "text_sha256", "n_points").alias("tag"), "kept")
    return keep_decided(docs, decided, id_col, tag)
