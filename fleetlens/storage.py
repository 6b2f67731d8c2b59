"""Small files and folders, through the file system that Spark uses."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _is(error: Py4JJavaError, name: str) -> bool:
    return name in error.java_exception.getClass().getName()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it is not there."""
    files, root = file_system(spark, path)
    try:
        return [s.getPath().getName() for s in files.listStatus(root)]
    except Py4JJavaError as error:
        if not _is(error, "FileNotFoundException"):
            raise
        return []


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The content of a file; None if it is not there."""
    files, file = file_system(spark, path)
    try:
        stream = files.open(file)
    except Py4JJavaError as error:
        if not _is(error, "FileNotFoundException"):
            raise
        return None
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder; False, and the source is gone, if there is a target."""
    jvm = spark.sparkContext._jvm
    files, draft = file_system(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(draft).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    # A rename to an empty folder would take its place.
    place = jvm.org.apache.hadoop.fs.Path(target)
    try:
        if not files.exists(place):
            context.rename(files.makeQualified(draft), files.makeQualified(place), plain)
            return True
    except Py4JJavaError as error:
        if not _is(error, "FileAlreadyExists"):
            raise
    files.delete(draft, True)
    return False


def write_json_new(spark: SparkSession, folder: str, name: str, content: dict) -> bool:
    """Write a file that is there as a whole or not at all; False if there is one."""
    files, draft = file_system(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(json.dumps(content, sort_keys=True).encode())
    finally:
        stream.close()
    return move_new(spark, draft.toString(), f"{folder}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    files, root = file_system(spark, path)
    if files.exists(root) and not files.delete(root, True):
        raise OSError(f"could not delete {path}")
