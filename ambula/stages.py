"""Stage tables: Parquet files in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ambula.session import shared_dir


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again; this cuts the lineage and survives lost executors.

    Spark deletes the files when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ambula/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
