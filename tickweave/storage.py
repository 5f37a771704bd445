"""Where the jobs keep tables between steps.

Everything goes below the folder named by ``spark.checkpoint.dir``, which every
executor reaches. A folder of our own is made only in local mode, when the
session names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tickweave-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch(spark: SparkSession, label: str) -> str:
    """A path of the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tickweave/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage: values that depend on the physical layout, such as
    partition numbers, stay fixed for every later reader and survive the loss
    of executors.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what this application left between its steps. For its end: results
    that still read staged tables are lost."""
    app = spark.sparkContext.applicationId
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tickweave/{app}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
