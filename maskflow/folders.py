"""Numbered folders that count as written once Spark has marked them whole."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    folder, files = _at(spark, path)
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder))


def whole(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was committed."""
    folder, files = _at(spark, f"{path}/_SUCCESS")
    return files.exists(folder)


def committed(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers of the folders ``<label>=<number>`` that were written whole, in order."""
    found = [re.fullmatch(rf"{label}=(\d+)", name) for name in names(spark, path)]
    return sorted(int(own[1]) for own in found if own and whole(spark, f"{path}/{own[0]}"))


def delete(spark: SparkSession, path: str) -> None:
    folder, files = _at(spark, path)
    files.delete(folder, True)
