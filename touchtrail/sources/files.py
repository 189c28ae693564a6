"""Small driver-side file operations in whatever file system a path names.

Only names, short texts and folders pass through here; data is read and written by Spark.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    system, at = _place(spark, folder)
    if not system.exists(at):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(at))


def stamp(spark: SparkSession, folder: str) -> int:
    """Changes whenever a file below the folder is added, removed, rewritten or resized."""
    system, at = _place(spark, folder)
    found, listed = system.listFiles(at, True), []
    while found.hasNext():
        status = found.next()
        listed.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hash(tuple(sorted(listed)))


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, at = _place(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text, whole and at once; False if there is one already.

    The text is written beside the path first and takes the name in one step that fails if
    the name is taken: a hard link on a local disk, a rename without overwriting elsewhere.
    Of any number of writers exactly one succeeds.
    """
    system, at = _place(spark, path)
    beside = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    system, draft = _place(spark, beside)
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    try:
        if system.getUri().getScheme() == "file":
            files = jvm.java.nio.file.Files
            place = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (at, draft)]
            files.createLink(*place)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                at.toUri(), spark._jsc.hadoopConfiguration()
            )
            options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(draft, at, options)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)
    return True
