"""Scratch tables in the shared folder of spark.checkpoint.dir, to cut lineage where a plan is used more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Scratch tables by application, for `clear`.
_MADE: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster names; a temporary one only where the setting is unset and the session is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(f"file://{named}")
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, written once and read back; `clear` removes what an application has written so."""
    path = f"{scratch_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    _MADE.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Remove this application's scratch tables, once nothing reads them any more; how many there were."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(made)
