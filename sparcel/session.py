"""Session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: dict[str, str] = {}
#: Bytes of a table's files that make a task; geometry takes far more time per byte than a plain scan.
SPLIT = 2 << 20


def local_session(cores: str = "8", memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("sparcel")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if _shipped.get("app") != sc.applicationId:
        root = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="sparcel-"), "sparcel.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, files in os.walk(root):
                for f in sorted(files):
                    if f.endswith(".py"):
                        p = os.path.join(folder, f)
                        z.write(p, os.path.join("sparcel", os.path.relpath(p, root)))
        sc.addPyFile(target)
        _shipped["app"] = sc.applicationId
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Let adaptive execution keep small partitions apart.

    The kernels use far more time per byte than a plain SQL stage, so the default floor of 1 MB
    would leave most cores idle. Results do not depend on it.
    """
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # a row may hold all edges of a tile, so batches are bounded by bytes as well
    # cut features outgrow any estimate: a side is broadcast only once it has been measured
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    # a row may hold all edges of a tile: few rows a batch, and no more bytes than this
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT))
    return ship(spark)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan evenly, in parts of about SPLIT bytes of its files and as many as there are cores at least.

    Only for plain scans (looking at the partitions of a plan with shuffles would run them). The splits
    of a scan tell its size, not where its rows are: all rows of a row group come with one of the splits it
    lies in, so a large table may have all its work in a few tasks.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(max(cores, scan.rdd.getNumPartitions()))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session, where they are one process, may go without and gets a temporary folder;
    on a cluster a missing setting is an error, as files on local disks could not be read again.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="sparcel-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name for files of this run, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint.

    The folder is that of ``shared_folder``.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)
