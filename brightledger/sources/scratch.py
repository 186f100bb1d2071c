"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of our own, by application: only for single machines where none is set, as in tests.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; on a single machine that names none, one of our own, the same for a whole application."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if folder:
        return folder
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = "file://" + tempfile.mkdtemp(prefix="brightledger-")
    return _OWN[application]


def fresh_path(spark: SparkSession) -> str:
    """A path of the shared folder that nothing is at yet."""
    return f"{shared_folder(spark)}/brightledger-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once and read back, so that a loop's plan does not grow with its rounds."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
