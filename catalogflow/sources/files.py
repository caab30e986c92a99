"""Small file-system steps that Spark's readers and writers do not cover, on any Hadoop file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A parquet table, or an empty one when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def decoded(path: Column) -> Column:
    """A file path as Spark's metadata columns give it, without its URL escapes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path, sorted."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a path, sorted."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def matched_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the paths that a path with wildcards, as readers take it, stands for."""
    p, fs = _path(spark, path)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(p) or [])


def claim(spark: SparkSession, path: str) -> bool:
    """Create a folder; false if it exists already."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        return False
    return fs.mkdirs(p)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name of its own and rename it to ``path``; false if that exists already.

    Readers see the whole file or none, and of several writers of one path only the first succeeds.
    """
    jvm = spark._jvm
    target, fs = _path(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def join_files(spark: SparkSession, path: str, pieces: list[str | tuple[str]], backup: str | None = None) -> None:
    """Write one file from texts and, for a tuple, the part files of the folder it names, in their order.

    Bytes go from stream to stream inside the JVM, so no more than a buffer is held. The file is renamed to ``path`` when it is
    whole; one that was there becomes ``backup``.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop
    target, fs = _path(spark, path)
    draft = hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        for piece in pieces:
            if isinstance(piece, str):
                stream.write(bytearray(piece.encode()))
                continue
            parts = [n for n in names(spark, piece[0]) if n.startswith("part-")]
            for name in sorted(parts, key=lambda n: int(n.split("-")[1])):
                source = fs.open(hadoop.fs.Path(f"{piece[0]}/{name}"))
                try:
                    hadoop.io.IOUtils.copyBytes(source, stream, 1 << 20, False)
                finally:
                    source.close()
    finally:
        stream.close()
    context = hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    over = gateway.new_array(hadoop.fs.Options.Rename, 1)
    over[0] = hadoop.fs.Options.Rename.OVERWRITE
    if backup is not None and fs.exists(target):
        context.rename(target, hadoop.fs.Path(backup), over)
    context.rename(draft, target, over)
