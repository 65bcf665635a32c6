"""Fresh folders that driver and executors share, and steps written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A path in ``spark.checkpoint.dir``, deleted when the driver's JVM ends. Where that is unset a local session gets a temporary folder; on a cluster that would be seen by one machine alone and is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir is not set; with master {master} it must name a folder that driver and executors share")
        root = tempfile.gettempdir()
    path = f"{root.rstrip('/')}/fairlead-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def keep(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once, to ``path`` or a scratch folder, and read back: what uses it several times computes it once, and a lost executor costs its tasks only."""
    path = path or scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
