"""Spark session helpers.

The library never creates clusters; it asks for the active session and only
fills in settings that are unset (tests, local runs).  On a cluster the
operator supplies ``spark.checkpoint.dir`` pointing at shared storage.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Defaults for local runs and tests.  AQE stays on so shuffle partitions
# coalesce and skewed joins split at runtime.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "hiermatch", conf: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with LOCAL_CONF."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app).master(master or os.environ.get("SPARK_MASTER", "local[8]"))
    for k, v in {**LOCAL_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` from the session; create a scratch one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # A machine-local folder is right only where driver and executors are one process.
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hiermatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df):
    """For one side of a join: both are shuffled.  By its file's size the planner would broadcast a table that is small only
    because it compresses well, through the driver."""
    return df.hint("merge")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per Spark context, if it lies in a plain folder."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(sc, "_hiermatch_shipped", False) or not root.is_dir():
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{shared_path(spark, 'package')}/{root.name}-package.zip"
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).create(hadoop)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path)
    sc._hiermatch_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed when the session's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = f"{(root or ensure_checkpoint_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
