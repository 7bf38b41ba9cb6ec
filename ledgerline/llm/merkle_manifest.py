"""Merkle manifest of a dataset: a tree of hashes per group, a tree of their roots above, and proofs climbed by a recursive query.

A leaf is the hash of a row's fields, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and its value. Per group (null is
one), leaves ascend by id (nulls first; rows that share an id by their leaf); while several nodes remain, each ``fan`` consecutive
ones become the hash of their concatenated hex digests. The groups' subroots, by group (null first, bytewise), are the
leaves of a last tree of the same kind. H is lowercase hex SHA-256.

``build`` writes the built levels as node rows linked to their parents: run, the children's digests, the run's own digest, the
run it belongs to (``up``) and its place there (``slot``). ``climb`` is a Spark recursive query over them: a row starts as a leaf,
each step joins the run it belongs to, appends the siblings found there and folds its hash with them, up to the root. The leaves of one
run share all siblings above their own, so they climb as one row that carries the folded hash of each.

Nulls: any field, the id and the group may be null. Empty and long texts are fields like others. Repeated rows are leaves of their
own, with one digest. An empty table has no nodes and gives no rows. Only the columns named are read, so others may have any
name. No group is held by one task: positions come from a range partitioning, and the levels shrink by ``fan``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS_MAX, salted_join, stored
from ledgerline.llm.ordering import positions

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
#: From the fields of a row to what they are changed to.
Tamper = Callable[[dict[str, Column]], dict[str, Column]]


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def digest(*parts: Column) -> Column:
    """Binary SHA-256 of the concatenated strings."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, hexed), "")


def leaf_digest(fields: dict[str, Column]) -> Column:
    return digest(*[field(c) for c in fields.values()])


def leaves(docs: DataFrame, group_col: str, id_col: str, fields: tuple[str, ...], tamper: Tamper | None) -> DataFrame:
    """(group: ``+`` and its value, empty for null; id, digest, changed: the digest of the tampered fields, null if none; at: position in the group)."""
    own = {c: F.col(f"`{c}`") for c in fields}
    changed = leaf_digest(tamper(own)) if tamper else F.lit(None).cast("binary")
    group = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    slim = docs.select(group.alias("group"), F.col(f"`{id_col}`").alias("id"), leaf_digest(own).alias("digest"), changed.alias("changed"))
    hashed = stored(slim, "hashed")  # the range partitioning reads its input twice; texts are hashed once
    return positions(hashed, ["group"], [F.col("id"), F.col("digest")], {"at": F.lit(1)}, "leaves")


def _runs(nodes: DataFrame, kind: str, level: int, fan: int, sizes: DataFrame | None, more: list[str]) -> DataFrame:
    """The runs of ``fan`` consecutive nodes; ``sizes`` has the nodes of each group (``n``) where ``nodes`` hasn't.

    A run: kind, group, at, n (runs of the group), run (its name), children, digest, up and slot (both null at the group's last node), ``entries``.
    """
    entry = F.struct("at", "digest", *more)
    runs = nodes.groupBy("group", F.expr(f"at div {fan}").alias("at")).agg(F.array_sort(F.collect_list(entry)).alias("entries"), *([] if sizes else [F.max("n").alias("n")]))
    if sizes:
        few = sizes.count() <= BROADCAST_ROWS_MAX
        runs = runs.join(F.broadcast(sizes), "group") if few else salted_join(runs, sizes, ["group"], "at")
    children = F.transform("entries", lambda e: e["digest"])
    alone, n = F.col("n") == 1, F.expr(f"(n + {fan - 1}) div {fan}")
    up = F.concat(F.lit(f"{kind}{level + 1}:"), F.expr(f"at div {fan}").cast("string"), F.lit(":"), F.col("group"))
    return runs.select(
        F.lit(kind).alias("kind"), "group", "at", n.alias("n"), alone.alias("alone"),
        F.concat(F.lit(f"{kind}{level}:"), F.col("at").cast("string"), F.lit(":"), F.col("group")).alias("run"), children.alias("children"),
        F.when(alone, F.get(children, F.lit(0))).otherwise(digest(_joined(children))).alias("digest"),
        F.when(n > 1, up).alias("up"), F.when(n > 1, F.expr(f"cast(at % {fan} as int)")).alias("slot"), *(["entries"] if more else []))


def _levels(nodes: DataFrame, kind: str, fan: int, more: list[str]) -> list[DataFrame]:
    """Stored runs, level by level, up to one node a group. No levels without nodes."""
    sizes = stored(nodes.groupBy("group").agg(F.count("*").alias("n")), f"{kind}-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    made: list[DataFrame] = []
    while most > 1 or (most and not made):
        made.append(stored(_runs(nodes, kind, len(made) + 1, fan, None if made else sizes, [] if made else more), f"{kind}{len(made) + 1}"))
        nodes, most = made[-1].where("n > 1").select("group", "at", "digest", "n"), -(-most // fan)
    return made


def build(docs: DataFrame, group_col: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS, fan: int = FAN, tamper: Tamper | None = None) -> tuple[DataFrame, DataFrame] | None:
    """The node rows (kind ``g`` in a group's tree, ``r`` in the last one; run, children, digest, up, slot), and of them the runs of
    leaves with their ``entries`` (at, digest, id, changed). None for an empty table."""
    levels = _levels(leaves(docs, group_col, id_col, fields, tamper), "g", fan, ["id", "changed"])
    if not levels:
        return None
    slim = ["kind", "alone", "run", "children", "digest", "up", "slot"]
    rows = reduce(DataFrame.unionByName, [level.select("group", "n", *slim) for level in levels])
    last = rows.where("n = 1").select("group", "digest")
    above: list[DataFrame] = []
    if last.limit(2).count() > 1:
        ranked = positions(last.withColumnRenamed("group", "name").withColumn("group", F.lit("")), ["group"], [F.col("name")], {"at": F.lit(1)}, "subroots")
        above = _levels(ranked, "r", fan, ["name"])
        place = ranked.select(F.col("name").alias("group"), F.concat(F.lit("r1:"), F.expr(f"at div {fan}").cast("string"), F.lit(":")).alias("top"),
                              F.expr(f"cast(at % {fan} as int)").alias("top_slot"))
        linked = rows.where("n = 1").join(place, "group").withColumn("up", F.col("top")).withColumn("slot", F.col("top_slot"))
        rows = rows.where("n > 1").select(*slim).unionByName(linked.select(*slim))
    nodes = stored(reduce(DataFrame.unionByName, [level.select(*slim) for level in above], rows.select(*slim)), "nodes")
    return nodes, levels[0].select("run", "entries")


#: A step of a climb: what is found in the run that a row belongs to goes to its siblings and into its folded hashes.
_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT run, up, slot, digest AS subroot, digest, folded, array() :: array<binary> AS siblings FROM {starts}
  UNION ALL
  SELECT c.run, r.up, r.slot, if(r.kind = 'g', r.digest, c.subroot) AS subroot, r.digest,
         transform(c.folded, f -> unhex(sha2(lower(concat(
             array_join(transform(slice(r.children, 1, c.slot), x -> hex(x)), ''), hex(f),
             array_join(transform(slice(r.children, c.slot + 2, size(r.children)), x -> hex(x)), ''))), 256))) AS folded,
         concat(c.siblings, slice(r.children, 1, c.slot), slice(r.children, c.slot + 2, size(r.children))) AS siblings
  FROM climb c JOIN {nodes} r ON c.up = r.run)
SELECT run, subroot, digest AS root, folded, siblings FROM climb WHERE up IS NULL
"""


def _others(children: Column, at: Column) -> Column:
    return F.concat(_joined(F.filter(children, lambda _, i: i < at)), _joined(F.filter(children, lambda _, i: i > at)))


def climb(nodes: DataFrame, leaf_runs: DataFrame) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof (hex of the siblings from the leaf to the root, joined), folded_root, all hex."""
    spark = nodes.sparkSession
    leaf = leaf_runs.join(nodes.drop("kind"), "run")
    kids = F.col("children")
    folded = F.transform("entries", lambda e, i: F.when(F.col("alone"), F.coalesce(e["changed"], e["digest"])).otherwise(digest(F.concat(
        _joined(F.filter(kids, lambda _, k: k < i)), hexed(F.coalesce(e["changed"], e["digest"])), _joined(F.filter(kids, lambda _, k: k > i))))))
    starts = stored(leaf.select("run", "up", "slot", "digest", folded.alias("folded")), "starts")
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # Spark's guard against endless recursion; this one ends at the root
    try:
        top = stored(spark.sql(_CLIMB, starts=starts, nodes=nodes), "climbed")
    finally:
        spark.conf.set(_ROW_LIMIT, before)
    found = top.join(leaf_runs, "run").select("subroot", "root", "folded", _joined(F.col("siblings")).alias("above"),
                                              F.transform("entries", lambda e: e["digest"]).alias("children"), F.posexplode("entries").alias("i", "e"))
    return found.select(F.col("e.id").alias("id"), hexed(F.col("e.digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"),
                        F.concat(_others(F.col("children"), F.col("i")), F.col("above")).alias("proof"), hexed(F.get("folded", F.col("i"))).alias("folded_root"))


def verify(docs: DataFrame, tamper: Tamper | None = None, group_col: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS, fan: int = FAN) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (the root as ``tamper``'s fields give it), verified."""
    built = build(docs, group_col, id_col, fields, fan, tamper)
    if built is None:
        kind = docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    rows = climb(*built)
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_third(fields: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """Tampering of a third of the rows, by the CRC-32 of their decimal id: A-Z of the text in lower case. A null id: none."""
    third = F.crc32(fields[id_col].cast("string").cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return fields | {text_col: F.when(third, F.translate(fields[text_col], upper, upper.lower())).otherwise(fields[text_col])}
