"""Small files and folder listings through the file system that Spark uses for a path."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def read_small(spark: SparkSession, path: str) -> str:
    """Text of one small file, such as a manifest."""
    return spark.read.text(path, wholetext=True).first()["value"]


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file that isn't there yet: aside first, then under its name at once."""
    system, place = _place(spark, path)
    if system.exists(place):
        raise FileExistsError(path)
    _, aside = _place(spark, f"{place.getParent()}/_{place.getName()}.aside")
    out = system.create(aside, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not system.rename(aside, place):
        raise OSError(f"{path} could not be put in place")


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """The file itself, or the files of a folder that Spark would read: path and ``address`` of each."""
    system, place = _place(spark, path)
    found = system.listStatus(place) if system.getFileStatus(place).isDirectory() else [system.getFileStatus(place)]
    kept = [s.getPath() for s in found if s.isFile() and s.getLen() and s.getPath().getName()[0] not in "._"]
    return sorted((p.toString(), re.sub("^([^:/]+):/+", r"\1:/", p.toUri().toString())) for p in kept)


def address() -> Column:
    """The file of a row, written as ``data_files`` writes addresses."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^([^:/]+):/+", "$1:/")


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a file."""
    jvm = spark.sparkContext._jvm
    system, place = _place(spark, path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(system.open(place), "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
