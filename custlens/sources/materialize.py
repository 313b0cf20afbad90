"""Write an intermediate table once to the cluster's shared checkpoint folder.

Used where a derived table feeds several independent branches: each branch
then scans parquet (with column pruning and filter pushdown) instead of
recomputing the lineage, and a lost executor costs a re-read, not a recompute.
The folder comes from the session (``spark.checkpoint.dir``).  Only a local-mode
session without that setting (tests, bench) writes to a scratch folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from custlens.session import ensure_checkpoint_dir


def stage(df: DataFrame, name: str) -> str:
    """Write ``df`` as parquet under the checkpoint folder; return the path."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/custlens-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return path


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table, as the file system lists them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(root)))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and scan it back."""
    return df.sparkSession.read.parquet(stage(df, name))
