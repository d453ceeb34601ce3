"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plan shape; everything else is cluster-specific.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "docweave") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("DOCWEAVE_DRIVER_MEM", "16g"))
         .config("spark.sql.files.maxPartitionBytes", str(64 << 20)))
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="docweave-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, as a table that is read back:
    compressed, column by column, and of known size (unlike ``checkpoint()``)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``docweave`` importable in Python workers (Arrow UDFs, mapInArrow)
    wherever the driver runs from: the package is zipped once per context and
    distributed with ``addPyFile``."""
    import shutil
    sc = spark.sparkContext
    if getattr(sc, "_docweave_shipped", False):
        return
    pkg_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = tempfile.mkdtemp(prefix="docweave-pyfiles-")
    archive = shutil.make_archive(os.path.join(base, "docweave"), "zip",
                                  root_dir=pkg_root, base_dir="docweave")
    sc.addPyFile(archive)
    sc._docweave_shipped = True
