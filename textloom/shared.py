"""The folder that driver and executors share, and what is written to it to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that a cluster names in ``spark.checkpoint.dir``.

    Only where it is unset and all of Spark runs in one process (tests) a
    temporary folder is made and registered; elsewhere that is an error, as
    executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def dealt_out(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to all cores by keys: few bytes that are much work lie in few splits of a file."""
    return df.repartition(max(2, df.sparkSession.sparkContext.defaultParallelism), *keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    This cuts lineage in a way that survives lost executors, and unlike
    ``checkpoint()`` it is columnar and compressed.
    """
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
