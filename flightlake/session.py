"""Session helper and the shared stage directory."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "flightlake", cpus: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    cores = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


# Settings that the wide cleaning projections rely on.  HotSpot never compiles a
# method above 8,000 bytes of bytecode, so one fused method over fifty columns
# runs interpreted: wide operators use split-up projections, narrow ones (all
# reports) stay fused.  Call-site capture costs seconds per wide plan.
SETTINGS = {
    "spark.sql.codegen.maxFields": "40",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # rows come in the order of their months: a task keeps the few files it writes open and sorts nothing
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # hand-over tables are written once and read a few times: less to write is worth the time
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


#: bytes of the source file behind one shuffle partition; its rows are some fifty times wider once cleaned
PARTITION_INPUT = 2 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def spread(spark: SparkSession, size: int) -> SparkSession:
    """Let shuffles start with partitions that suit a source of `size` bytes.

    A task then sorts what fits its memory instead of spilling; adaptive execution merges
    partitions that turn out small.  The number is only ever raised.
    """
    wanted = -(-size // PARTITION_INPUT)
    if wanted > partitions(spark):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: what `spark.checkpoint.dir` names.

    Only a local session may fall back to a temporary folder, because there
    driver and executors are one process on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="flightlake-")
    return _LOCAL_ROOTS[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """Fresh path for one stage table; no two calls share a folder."""
    safe = re.sub(r"[^A-Za-z0-9_.-]+", "_", name)
    return f"{stage_root(spark)}/flightlake/{spark.sparkContext.applicationId}/{safe}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared stage folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner a file size, so that a later join is broadcast only when the table
    is really below `spark.sql.autoBroadcastJoinThreshold`.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
