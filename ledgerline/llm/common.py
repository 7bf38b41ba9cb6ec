"""Helpers shared by the operators of this package: scratch tables, free names, joins on hot keys."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows below which a per-key table may be broadcast; callers count the table first.
BROADCAST_ROWS_MAX = 100_000
#: Ways in which one key of a salted join is split.
SALTS = 32
#: A key is heavy if it repeats and holds one in ``HEAVY_MAX`` of the rows or more, so there are ``HEAVY_MAX`` heavy keys at most.
HEAVY_MAX = 1000


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-llm-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    _delete_at_exit(spark, context.getCheckpointDir())  # a folder of this application in the root
    return root.rstrip("/")


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and row ids or names
    assigned before the write never change afterwards. The table goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def map_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package's modules sent along to the Python workers, wherever they run."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        here = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="ledgerline-llm-")).resolve() / "ledgerline_llm.zip"
        with zipfile.ZipFile(archive, "w") as out:
            out.writestr("ledgerline/__init__.py", "")
            for module in sorted(here.glob("*.py")):
                out.write(module, f"ledgerline/llm/{module.name}")
        context.addPyFile(str(archive))  # Spark serves it to the executors
        _shipped.add(context.applicationId)
    return df.mapInArrow(run, schema)


_owner: list[str] = []
_releases: list[Callable[[], object]] = []


def on_change_of_owner(release: Callable[[], object]) -> None:
    """Register what frees an operator's tables in a Python worker."""
    _releases.append(release)


def own_worker(name: str) -> None:
    """Called by an operator's tasks: a Python worker that last ran another operator frees that one's tables first.

    Workers outlive stages, so the tables of all operators would otherwise add up in each.
    """
    if _owner != [name]:
        for release in _releases:
            release()
        gc.collect()
        _owner[:] = [name]


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """For each base a column name that ``df`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    names = []
    for base in bases:
        name = f"__{base}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str | Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``left`` join ``right`` on ``keys``, each key split ``salts`` ways by the left column or expression ``spread``.

    ``right`` has one row per key, so repeating it is bounded by ``salts`` rows a key, and a key
    that holds a third of ``left`` is dealt to ``salts`` tasks. Always a merge join: the repeated
    rows are never broadcast. ``how`` is inner or left.
    """
    (salt,) = fresh(left, "salt")
    split = left.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{spread}`") if isinstance(spread, str) else spread), F.lit(salts)))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return split.join(copies.hint("merge"), [*keys, salt], how).drop(salt)


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str, tag: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, tag: string, kept; a row for each row of docs) keeps, with all columns.

    A doc_id (null included) that occurs once finds its decision by a join on it. Rows of a doc_id that
    occurs more often are told apart by their tag, which ``tag(rows, column)`` works out again for
    them alone; rows that share both are repeated rows, of which one stays. The join of the texts is a merge join at
    every size. Texts of a heavy doc_id (null, say, for a third of the rows) are never dealt by it: those ids are
    ``HEAVY_MAX`` at most and are broadcast; their rows are dealt by id and tag, repeated ones combined before.
    """
    key, name = fresh(docs, "key", "tag")
    decided = stored(decided.select(F.col("doc_id").alias(key), F.col("tag").alias(name), "kept"), "decided")
    share = F.lit(decided.count()) / F.lit(HEAVY_MAX)
    per_key = decided.groupBy(key).agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    per_key = per_key.withColumn("heavy", (F.col("n") > 1) & (F.col("n") >= share)).where("kept or heavy")
    per_key = stored(per_key.select(key, "n", "kept", "heavy"), "decided-keys")
    keyed = docs.withColumn(key, F.col(f"`{id_col}`"))

    def has(rows: DataFrame, wanted: DataFrame, *more: str, how: str = "left_semi") -> DataFrame:
        match = rows[key].eqNullSafe(wanted[key])
        for c in more:
            match = match & (rows[c] == wanted[c])
        return rows.join(wanted, match, how)

    heavy = F.broadcast(per_key.where("heavy").select(key))  # HEAVY_MAX rows at most
    kept = has(has(keyed, heavy, how="left_anti"), per_key.where("n = 1").select(key).hint("merge"))
    several = per_key.where("n > 1 and kept").select(key, "heavy")
    n_several = several.count()

    def of_several(rows: DataFrame) -> DataFrame:
        if n_several <= BROADCAST_ROWS_MAX:
            return has(rows, F.broadcast(several.select(key)))
        others = has(has(rows, heavy, how="left_anti"), several.where("not heavy").select(key))
        return has(rows, F.broadcast(several.where("heavy").select(key))).unionByName(others)

    if n_several:
        tags = of_several(decided.where("kept").drop("kept")).distinct()
        found = has(tag(of_several(keyed), name).dropDuplicates([key, name]), tags, name)
        kept = kept.unionByName(found.drop(name))
    return kept.drop(key)
