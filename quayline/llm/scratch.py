"""Removing what this package has written."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, whichever kind that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
