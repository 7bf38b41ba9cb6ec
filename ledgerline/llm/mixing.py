"""Mixing sources to target weights by repetition rates.

The words of every source are summed; the sources, in order of code points with null last, get the weights
``weights`` in turn; each weight's share of all words is a source's target, capped at ``most`` times the source's own
words, the excess being reshared by weight among the others until none is above its cap. A
source's rate is its target over its words. Each of its documents is emitted floor(rate) times, and once more if a
number in [0, 1), made from a hash of the seed and doc_id, is below the rate's fraction. So reruns agree, and
no document exceeds ``most`` times its size.

Only one row per source is shuffled. Their order comes from a range sort, and the resharing reads two sums a round;
no list of sources is collected. The table of rates is broadcast only below ``BROADCAST_ROWS_MAX``
sources, which are counted, and beyond that joined with each source salted.

Null text has no words; a source without words has target and rate 0, and its documents aren't taken. Null is a
source of its own, apart from the empty name. Repeated rows share their doc_id and so their draw; a null
doc_id has a draw of its own. An empty table gives an empty result. Further columns play no part in ``plan`` and
stay in ``mix``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS_MAX, fresh, salted_join, stored

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 17
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    inner = F.btrim(text, F.lit(_BLANKS))  # then each word, with the blanks behind it, becomes one letter
    return F.coalesce(F.length(F.regexp_replace(inner, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")), F.lit(0)).cast("long")


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) of the seed and the id: the first 12 hex digits of an MD5, over 16^12."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) per source, from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = stored(per.withColumn("last", F.col("source").isNull()).orderBy("last", "source")
                    .withColumn("at", F.monotonically_increasing_id()), "sources")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row per sorted partition
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("before") + F.col("row"), F.lit(len(weights))) + 1).cast("int"))
    weighed = (placed.withColumns({"part": part, "row": row}).join(F.broadcast(before), "part")
               .select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")))
    weighed = stored(weighed, "weights")
    total, share = weighed.agg(F.sum("source_size")).first()[0] or 0, None
    while True:  # the share of one unit of weight among the sources that aren't at their cap
        at_cap = F.lit(False) if share is None else F.col("weight") * F.lit(share) > F.col("cap")
        capped, open_weight = weighed.agg(F.sum(F.when(at_cap, F.col("cap")).otherwise(0)), F.sum(F.when(at_cap, 0).otherwise(F.col("weight")))).first()
        now = (total - (capped or 0)) / open_weight if open_weight else 0.0
        if share is not None and now <= share:
            break
        share = now
    target = F.when(F.col("weight") * F.lit(share) > F.col("cap"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(share))
    return weighed.select("source", "source_size", target.alias("target"),
                          F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0).alias("rate"))


def _rated(docs: DataFrame, text_col: str, source_col: str, id_col: str, weights: tuple[int, ...], most: int, seed: int) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with size, source_size, target and copies under free names, which the second value gives."""
    names = dict(zip(("size", "source", "none", "source_size", "target", "rate", "copies"),
                     fresh(docs, "size", "source", "none", "source_size", "target", "rate", "copies"), strict=True))
    source = F.col(f"`{source_col}`").cast("string")
    sizes = docs.select(source.alias("source"), words(F.col(f"`{text_col}`").cast("string")).alias("size"))
    found = rates(sizes, weights, most)
    n_sources = found.count()
    keyed = found.select(F.coalesce("source", F.lit("")).alias(names["source"]), F.col("source").isNull().alias(names["none"]),
                         *[F.col(c).alias(names[c]) for c in ("source_size", "target", "rate")])
    sized = docs.withColumns({names["size"]: words(F.col(f"`{text_col}`").cast("string")), names["source"]: F.coalesce(source, F.lit("")),
                              names["none"]: source.isNull()})
    keys = [names["source"], names["none"]]
    out = sized.join(F.broadcast(keyed), keys) if n_sources <= BROADCAST_ROWS_MAX else salted_join(sized, keyed, keys, F.xxhash64(f"`{id_col}`", f"`{text_col}`"))  # ids may be null
    rate = F.col(names["rate"])
    extra = (draw(F.col(f"`{id_col}`"), seed) < rate - F.floor(rate)).cast("long")
    return out.withColumn(names["copies"], F.floor(rate) + extra), names


def plan(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
         weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (size times its copies), copies."""
    rated, names = _rated(docs, text_col, source_col, id_col, weights, most, seed)
    size, copies = F.col(names["size"]), F.col(names["copies"])
    return rated.select(F.col(f"`{id_col}`").alias("doc_id"), size.alias("size"), F.col(names["source_size"]).alias("source_size"),
                        F.col(names["target"]).alias("target"), (size * copies).alias("taken"), copies.alias("copies"))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixture: each row of ``docs`` as often as it is taken, with all its columns."""
    rated, names = _rated(docs, text_col, source_col, id_col, weights, most, seed)
    copies = F.col(names["copies"])
    repeated = rated.where(copies > 0).withColumn(names["copies"], F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return repeated.select(*[f"`{c}`" for c in docs.columns])
