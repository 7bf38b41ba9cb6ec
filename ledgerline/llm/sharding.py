"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

A uniformly random permutation cut into shards is drawn in four steps, each of them DataFrame functions only:

1. Input rows lie in chunks of at most ``chunk_rows`` (pieces of the partitions as read). How many rows each chunk sends to
   each shard is drawn from the multivariate hypergeometric law with the chunks' row counts and the shards' exact
   sizes as margins: first for groups of chunks, then, in parallel, for the chunks of each group.
2. Each chunk permutes its rows; the drawn counts cut the permutation into shards.
3. Rows are exchanged.
4. Each shard permutes what it got: rows fall at random into buckets of about ``chunk_rows``, are permuted there, and the buckets' offsets
   give gapless slots.

No window holds more than a chunk or a bucket; a chunk never depends on a key, so hot keys and copies don't matter. The
matrix has a row per chunk, not per row. Row ids are written before they are used, and all draws
are hashes of them and the seed, so lost tasks repeat themselves.

Shards hold equal numbers of rows up to one (law ``rows``). Null text has size 8 and the checksum of no bytes. Repeated rows
and equal texts are rows of their own. Fewer rows than shards leave some empty. An empty table gives an empty result. Further
columns play no part in ``assign``; ``shuffle`` and ``write_shards`` carry them, but refuse columns named ``shard`` or ``slot``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, stored

SHARDS = 24
SEED = 6
CHUNK_ROWS = 65_536


def _unit(*columns: Column) -> Column:
    """A number in (0, 1) from a hash of the columns."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") + 0.5) / float(1 << 52)


def _log_factorial(x: Column) -> Column:
    """Stirling's series at x + 8, less the logarithms of the eight factors in between."""
    z = x + 8.0
    series = z * F.log(z) - z + 0.5 * F.log(2 * math.pi * z) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    between = x + 1.0
    for k in range(2, 9):
        between = between * (x + float(k))
    return series - F.log(between)


def hypergeometric(good: Column, bad: Column, draws: Column, unit: Column) -> Column:
    """A draw of the number of good items among ``draws`` of ``good + bad``, by inversion from the mode outwards.

    All are doubles with whole values. The walk covers twelve standard deviations on both sides.
    """
    parts = F.struct(F.greatest(F.lit(0.0), draws - bad).alias("low"), F.least(draws, good).alias("high"),
                     good.alias("g"), bad.alias("b"), draws.alias("n"), unit.alias("u"))

    def walk(v: Column) -> Column:
        low, high, g, b, n = v["low"], v["high"], v["g"], v["b"], v["n"]
        mode = F.least(high, F.greatest(low, F.floor((n + 1) * (g + 1) / (g + b + 2)).cast("double")))
        log_p = (_log_factorial(g) + _log_factorial(b) + _log_factorial(n) + _log_factorial(g + b - n) - _log_factorial(g + b)
                 - _log_factorial(mode) - _log_factorial(g - mode) - _log_factorial(n - mode) - _log_factorial(b - n + mode))
        spread = F.sqrt(n * (g / (g + b)) * (b / (g + b)) + 1.0)
        steps = F.least(high - low, F.ceil(12 * spread + 12).cast("double")).cast("int")
        first = F.struct((v["u"] - F.exp(log_p)).alias("left"), mode.alias("up"), F.exp(log_p).alias("p_up"),
                         mode.alias("down"), F.exp(log_p).alias("p_down"), mode.alias("found"), F.lit(False).alias("done"))

        def step(s: Column, _: Column) -> Column:
            done = s["done"] | (s["left"] < 0)
            p_up = s["p_up"] * ((g - s["up"]) * (n - s["up"]) / ((s["up"] + 1) * F.greatest(F.lit(1.0), b - n + s["up"] + 1)))
            p_down = s["p_down"] * (s["down"] * (b - n + s["down"]) / (F.greatest(F.lit(1.0), g - s["down"] + 1) * F.greatest(F.lit(1.0), n - s["down"] + 1)))
            left_up = s["left"] - p_up
            return F.struct(F.when(done, s["left"]).otherwise(left_up - p_down).alias("left"), (s["up"] + 1).alias("up"), p_up.alias("p_up"),
                            (s["down"] - 1).alias("down"), p_down.alias("p_down"),
                            F.when(done, s["found"]).when((left_up < 0) | (p_down <= 0), F.least(high, s["up"] + 1)).otherwise(F.greatest(low, s["down"] - 1)).alias("found"),
                            done.alias("done"))

        walked = F.aggregate(F.sequence(F.lit(1), steps), first, step, lambda s: s["found"])
        return F.when(high <= low, low).when(v["u"] < F.exp(log_p), mode).otherwise(walked)

    return F.element_at(F.transform(F.array(parts), walk), 1)


def deal(members: Column, room: Column, seed: int) -> Column:
    """Array of (id, counts): for each member (id, n) in turn its draws from the ``room`` left in each shard (doubles).

    The conditional law of each entry, given those before it, is hypergeometric.
    """
    numbers = F.array().cast("array<double>")

    def of_member(state: Column, member: Column) -> Column:
        def of_shard(inner: Column, shard: Column) -> Column:
            space = F.element_at(state["room"], shard)
            x = hypergeometric(space, inner["after"] - space, inner["n"], _unit(F.lit(seed), member["id"], shard))
            drawn = F.element_at(F.transform(F.array(x), lambda y: F.struct((inner["after"] - space).alias("after"), (inner["n"] - y).alias("n"),
                                                                            F.array_append(inner["counts"], y).alias("counts"))), 1)
            return drawn

        first = F.struct(F.aggregate(state["room"], F.lit(0.0), lambda a, b: a + b).alias("after"), member["n"].alias("n"), numbers.alias("counts"))
        counts = F.aggregate(F.sequence(F.lit(1), F.size(state["room"])), first, of_shard, lambda s: s["counts"])
        return F.element_at(F.transform(F.array(counts), lambda c: F.struct(
            F.zip_with(state["room"], c, lambda a, b: a - b).alias("room"),
            F.array_append(state["dealt"], F.struct(member["id"].alias("id"), c.alias("counts"))).alias("dealt"))), 1)

    start = F.struct(room.alias("room"), F.array().cast("array<struct<id:bigint,counts:array<double>>>").alias("dealt"))
    return F.aggregate(members, start, of_member, lambda s: s["dealt"])


def matrix(chunks: DataFrame, shards: int, seed: int) -> DataFrame:
    """(chunk, counts) from (chunk, n): the communication matrix, rows as wide as there are shards."""
    total, n_chunks = chunks.agg(F.sum("n"), F.count("*")).first()
    n_groups = max(1, math.isqrt(n_chunks))
    sizes = F.array(*[F.lit(float((total or 0) // shards + (s < (total or 0) % shards))) for s in range(shards)])
    listed = F.array_sort(F.collect_list(F.struct(F.col("chunk").alias("id"), F.col("n").cast("double").alias("n"))))
    groups = (chunks.withColumn("of", F.pmod(F.xxhash64(F.lit(seed), "chunk"), F.lit(n_groups)))
              .groupBy("of").agg(F.sum("n").alias("n"), listed.alias("members")))  # about the root of the number of chunks each
    groups = stored(groups, "chunk-groups")
    whole = groups.agg(F.array_sort(F.collect_list(F.struct(F.col("of").alias("id"), F.col("n").cast("double").alias("n")))).alias("members"))
    dealt = stored(whole.select(F.explode(deal(F.col("members"), sizes, seed)).alias("d")).select(F.col("d.id").alias("of"), F.col("d.counts").alias("room")), "group-matrix")
    return (groups.join(dealt, "of").select(F.explode(deal(F.col("members"), F.col("room"), seed + 1)).alias("d"))
            .select(F.col("d.id").alias("chunk"), F.col("d.counts").alias("counts")))


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard); clashing names of ``docs`` are an error.

    Select the columns to carry first: they are written once and exchanged once.
    """
    if {"shard", "slot"} & {c.lower() for c in docs.columns}:
        raise ValueError("rename the columns shard and slot first")
    at, chunk, rank, shard, bucket = fresh(docs, "at", "chunk", "rank", "shard", "bucket")
    rows = stored(docs.withColumn(at, F.monotonically_increasing_id()), "rows")
    row = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    chunked = rows.withColumn(chunk, F.col(at) - F.pmod(row, F.lit(chunk_rows)))  # the id of the chunk's first row
    counted = stored(chunked.groupBy(F.col(chunk).alias("chunk")).agg(F.count("*").alias("n")), "chunks")
    sums = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(F.slice("counts", F.lit(1), k), F.lit(0.0), lambda a, b: a + b))
    cuts = stored(matrix(counted, shards, seed).select(F.col("chunk").alias(chunk), sums.alias("cuts")), "matrix")
    local = Window.partitionBy(chunk).orderBy(F.xxhash64(F.lit(seed), F.lit("chunk"), F.col(at)), at)
    sent = (chunked.withColumn(rank, F.row_number().over(local)).join(cuts, chunk)
            .withColumn(shard, F.size(F.filter("cuts", lambda c: c < F.col(rank)))).drop("cuts", chunk, rank))
    per_shard = math.ceil((counted.agg(F.sum("n")).first()[0] or 0) / shards)
    buckets = max(1, math.ceil(per_shard / chunk_rows))
    sent = stored(sent.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), F.col(at)), F.lit(buckets))), "sent")
    sizes = sent.groupBy(shard, bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    offsets = sizes.select(shard, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    again = Window.partitionBy(shard, bucket).orderBy(F.xxhash64(F.lit(seed), F.lit("slot"), F.col(at)), at)
    placed = sent.withColumn(rank, F.row_number().over(again)).join(offsets, [shard, bucket])
    return placed.select(*[f"`{c}`" for c in docs.columns], F.col(shard).cast("int").alias("shard"), (F.col("before") + F.col(rank) - 1).cast("long").alias("slot"))


def assign(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shuffle(slim, shards, seed, chunk_rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, chunk_rows: int = CHUNK_ROWS) -> None:
    """Write ``docs`` as Parquet, a folder ``shard=k`` for each shard, its files in order of slots."""
    out = shuffle(docs, shards, seed, chunk_rows)
    ranged = out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").mode("overwrite").parquet(path)
