"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizing (executors, memory, shuffle partitions) belongs to the cluster; only settings that
# change results or that let Spark adapt at run time are set here.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

LEAST_PARTITIONS = 200
"""Shuffle partitions before adaptive execution puts small ones together."""


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in {**RESULT_SETTINGS, **ADAPTIVE_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app_name: str = "estrato", memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A single-process session for tests and the bench; ``shared`` is its shared folder, new by default."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="estrato-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where it is set, else one in the warehouse.

    On a cluster a warehouse on the driver's own disk is refused: executors would not see its files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and re.match(r"file:|/", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_shared"


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder name not used before, in the application's scratch folder below the shared one."""
    return f"{scratch_folder(spark)}/{what}-{uuid.uuid4().hex}"


def small_partitions(spark: SparkSession) -> None:
    """Adaptive execution puts shuffle blocks together up to 8 MB a task, so a task's memory doesn't grow with its input.

    A join of which one side has no larger partition than that hashes it instead of sorting both; others sort and spill.
    What the session sets itself stays.
    """
    partitions = max(LEAST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chosen = {"advisoryPartitionSizeInBytes": "8m", "coalescePartitions.initialPartitionNum": str(partitions), "maxShuffledHashJoinLocalMapThreshold": "8m"}
    for name, value in chosen.items():
        if spark.conf.get(f"spark.sql.adaptive.{name}", None) is None:
            spark.conf.set(f"spark.sql.adaptive.{name}", value)


def kept(df: DataFrame, what: str) -> DataFrame:
    """The table written to the scratch folder and read back: what several steps read is worked out once."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/estrato-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application. Call it when its results are written elsewhere."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
