"""Folders of the file system that holds a table, seen as Spark sees them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under `path`, ordered; none if there is no `path`."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right under `path`, ordered; none if there is no `path`."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    """The content of one small file."""
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, that appears whole: written beside its place and renamed into it."""
    files, place = _file_system(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        place.getParent(), f"_{place.getName()}.part")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(beside, place):
        raise OSError(f"cannot rename {beside.toString()} to {place.toString()}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all its content; none is no error."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
