"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", app: str = "shelftide") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own configuration."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (SparkSession.builder.master(f"local[{cpus}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", partitions)
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            # Building a Column otherwise records its Python call site, which costs more
            # than planning it.
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.driver.memory", "12g")
            .getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may go without one and then gets a
    folder of its own, removed at exit: on a cluster executors would each write to their own disk."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share "
                               f"(master {master})")
        root = tempfile.mkdtemp(prefix="shelftide-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """One folder for each run (application) under the shared root."""
    return f"{shared_root(spark)}/shelftide-{spark.sparkContext.applicationId}"


def drop_run_tables(spark: SparkSession) -> None:
    """Remove what this run has written. Results still to be read must be read before."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a result once to the shared folder and go on from the written table.

    Cuts the lineage and fixes values that depend on where a row was placed, so a lost
    executor re-reads files instead of recomputing (and re-placing) rows.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
