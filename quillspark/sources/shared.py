"""The cluster's shared folder, and tables in it that end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, local mode has one of its own;
    a cluster has none, and fails."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='quillspark-')}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def table_path(spark: SparkSession, name: str) -> str:
    """A new place for a table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of a small table's file.
FILE_ROWS = 250_000


def cut(df: DataFrame, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """df written to a table in the shared folder and read again: lineage ends here, steps that several others read run
    once, and a lost executor costs no rerun of what came before.

    rows: at most so many rows; they go to a file for each `each` rows, not to one for each partition."""
    path = table_path(df.sparkSession, "cut")
    (df if rows is None else df.coalesce(rows // each + 1)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
