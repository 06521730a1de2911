"""Small metadata files and folders, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write(spark: SparkSession, path: str, text: str = "") -> None:
    """Put a small file in place whole: written aside, then renamed."""
    fs, p = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), "_" + p.getName())
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = getattr(hadoop, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = overwrite
    # One step: a reader sees the old file or the new one.
    hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, options)


def read(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
