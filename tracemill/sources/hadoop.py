"""Small files and folders on whatever file system a path names, through Spark's Hadoop classes (driver only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    where, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.delete(where, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    where, fs = _at(spark, path)
    if not fs.rename(where, _at(spark, to)[0]):
        raise OSError(f"{path} was not renamed to {to}")


def read_text(spark: SparkSession, path: str) -> str | None:
    where, fs = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside and renamed, so that readers see the old text or the new one."""
    part = path.rsplit("/", 1)
    beside = f"{part[0]}/_{part[1]}.new"
    where, fs = _at(spark, beside)
    stream = fs.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    delete(spark, path)
    rename(spark, beside, path)
