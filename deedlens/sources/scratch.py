"""Shared scratch space for intermediate files.

One rule for every master: the folder is the one that the session names in
``spark.checkpoint.dir``. Where that is unset, as in tests, a folder below the
warehouse is used and set, because the warehouse is shared by all executors
too. A machine-local temporary folder is never used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session, without a slash at its end."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """What this application has written, all of it below one folder."""
    return f"{scratch_dir(spark)}/deedlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder, under the running application."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever file system it lies; a missing path is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete everything that this application stored; call it when no result is read any more."""
    remove(spark, run_dir(spark))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to a path and read it back with the same schema."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a frame to shared scratch files and read it back; this runs a job.

    Three things follow. A frame that is read more than once is computed once,
    and executor loss costs a re-read. Rows keep the numbers they were given,
    where a recomputed sort might cut its ranges elsewhere. And Catalyst knows
    the size from the files: it broadcasts the frame below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it above, in a form
    whose skewed partitions AQE can split.
    """
    return stored_at(df, scratch_path(df.sparkSession, name))
