"""Folder listing through Hadoop's FileSystem, so every storage Spark reads works the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, fs = _path(spark, location)
    return fs.exists(path)


def child_folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders directly below ``location``."""
    path, fs = _path(spark, location)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern."""
    path, fs = _path(spark, pattern)
    found = fs.globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found is not None else []


def remove(spark: SparkSession, location: str) -> None:
    path, fs = _path(spark, location)
    fs.delete(path, True)


def names(spark: SparkSession, location: str) -> list[str]:
    """Names of the files directly in a folder; hidden ones and checksums are left out."""
    path, fs = _path(spark, location)
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path) if s.isFile()]
    return sorted(n for n in found if not n.startswith((".", "_")))


def text(spark: SparkSession, location: str) -> str:
    """The content of a small text file."""
    path, fs = _path(spark, location)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, location: str, content: str) -> None:
    path, fs = _path(spark, location)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, location: str, content: str) -> bool:
    """Make a file that must not exist appear with its whole content; whether that succeeded.

    The content is written aside under a hidden name first, so nobody ever sees a part of it. It then takes its
    name by a call that fails if the name is taken: a hard link on a local file system, elsewhere a rename that
    does not overwrite. HDFS does that in one step; on a store without such a rename, one writer at a time.
    """
    from py4j.protocol import Py4JJavaError

    folder, name = location.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    _write(spark, aside, content)
    jvm = spark._jvm
    source, fs = _path(spark, aside)
    target, _ = _path(spark, location)
    try:
        if fs.getUri().getScheme() == "file":
            place = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(place(target), place(source))
        else:
            options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            wanted = spark.sparkContext._gateway.new_array(options, 1)
            wanted[0] = options.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(source, target, wanted)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    finally:
        remove(spark, aside)
    return True


def rename(spark: SparkSession, location: str, wanted: str) -> None:
    path, fs = _path(spark, location)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(wanted)):
        raise OSError(f"cannot rename {location} to {wanted}")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows that are needed several times under the shared folder and read them back; the files go
    when the session ends."""
    spark = df.sparkSession
    location = scratch_path(spark, purpose)
    df.write.parquet(location)
    path, fs = _path(spark, location)
    fs.deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(location)
