"""Tables cut off from their lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir, or in local runs that don't set it a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="tileweave-"))
        found = _LOCAL[0]
    return found


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage ends there, and lost executors cost nothing.

    The files go when the driver's JVM ends, or by drop().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def spread(df: DataFrame) -> DataFrame:
    """df as one side of a join that shuffles and sorts both sides.

    The planner takes rows that arrays were exploded into for as small as the file that they come from, and would broadcast them
    by the driver however many they are. For sides that grow with the input by more than their file shows.
    """
    return df.hint("merge")


def drop(df: DataFrame) -> None:
    """Delete what cut() wrote for df; df can't be read afterwards."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
