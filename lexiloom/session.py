"""Where intermediate tables live, and how a job cuts its lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _root(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    It must be visible to every executor, so a machine-local one is made up only
    for a local master on which none is configured.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="lexiloom-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/lexiloom/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession) -> str:
    """A fresh path for intermediate files."""
    return f"{_root(spark)}/{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Deletes the intermediate files of this application, at the end of a job: results that are still to be computed need them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    A lost executor then costs a re-read, not a recomputation, and the
    optimizer sees the true size of the table: later joins broadcast it only
    when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_once(df: DataFrame) -> DataFrame:
    """``df`` as a table that several jobs read, its last shuffle done once for all of them.

    Partitions have as many rows in each job, and no copy is stored but the
    shuffle files. After the loss of an executor its part is computed anew.
    """
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)
