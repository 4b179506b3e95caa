"""Session settings the operators rely on."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set on any session handed in; all of them can be changed at run time.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when the operator above then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Coded columns unpack to several times their file size; what is broadcast is the unpacked table.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.session.timeZone": "UTC",
    # Bad currency text must fail the job and not turn into null.
    "spark.sql.ansi.enabled": "true",
    # The sales extracts are Windows-1252, which Spark 4 only reads with this switch.
    "spark.sql.legacy.javaCharsets": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a one-machine session without one gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = _own_folder(spark.sparkContext.applicationId)
    return named


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="indexloom-")


def stage(df: DataFrame) -> DataFrame:
    """Write a frame that several branches read to the shared folder, and read it back.

    It is computed once, lost executors cannot take it, and its size is known to the joins after it.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows that one task sorts as a whole.
ROWS_PER_TASK = 1 << 18


def tasks_for(df: DataFrame, rows_per_task: int | None = None) -> int:
    """Tasks to deal the rows of a frame over so that the rows of one do not grow with the frame."""
    return max(1, -(-df.count() // (rows_per_task or ROWS_PER_TASK)))


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """One-machine session for tests and the bench; a cluster brings its own."""
    scratch = os.environ.get("INDEXLOOM_SCRATCH", "/tmp")
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("indexloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "indexloom-warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
