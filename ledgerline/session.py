"""Spark session settings shared by the library, the tests and the benchmark.

Nothing here is required by the library functions themselves: every function takes a
``SparkSession`` or ``DataFrame`` from the caller. ``local_session`` is for tests and the
benchmark; on a cluster the job's own session is used and only ``checkpoint_dir`` (which reads ``spark.checkpoint.dir``) and
``recommended_conf`` matter.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every session running this library should have. AQE re-plans joins from runtime
# sizes (broadcast only when a side really is small), coalesces small shuffle partitions and
# splits skewed ones. Dates come from wall-clock NTZ timestamps, so the zone only affects
# ``current_timestamp`` in the audit trail; it is pinned to UTC so audit rows are comparable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.ansi.enabled": "true",
    # Spark 4.1 may take a union's partitioning from its parts and skip the exchange of what follows. A union of
    # joins over one table then gave wrong windows (tests/test_history.py), so the exchange is kept.
    "spark.sql.unionOutputPartitioning": "false",
    # Layer tables are written once and scanned by many jobs: zstd files are markedly smaller
    # than snappy's at a small write-time cost, so every later scan reads fewer bytes.
    "spark.sql.parquet.compression.codec": "zstd",
    # Python call-site capture for error messages costs about five JVM round trips per
    # DataFrame API call while a plan is built (measured: plan construction 37% faster
    # without it). Batch jobs keep Spark's own error context; only the Python file:line goes.
    # A static setting: it takes effect when the session is created.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def recommended_conf() -> dict[str, str]:
    return dict(RECOMMENDED_CONF)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session, never invented: a job that needs it on a cluster where it is unset
    fails here, instead of falling back to a folder on one machine's disk that a restarted
    driver or another executor could not see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage the whole cluster can reach")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured  # not Spark's folder of this application in it: a restarted driver finds its streams again

