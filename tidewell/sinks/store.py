"""Small files and folder listings on whatever file system Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    files, place = _at(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: it is renamed into place, and an existing one is never replaced."""
    files, place = _at(spark, path)
    if files.exists(place):
        raise FileExistsError(path)
    # The name hides a half-written file from Spark's readers.
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.draft")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, place):
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)
