"""Small text files and listings through the Hadoop file system, so that any store that Spark reads will do."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def size(spark: SparkSession, path: str) -> int | None:
    """Total bytes under ``path`` (metadata only), None if it does not exist."""
    fs, p = _open(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else None


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """Put a small file in place in one act: readers see the old text or the new one, never a part."""
    sc = spark.sparkContext
    fs, p = _open(spark, path)
    aside = sc._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(p), how)
    return path


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    fs, p = _open(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


def fingerprint(spark: SparkSession, *paths: str | None) -> str:
    """A key of what lies under ``paths``: names, lengths and times of change of all files, from metadata alone.

    A path that is None or does not exist counts as such, so any other text can be part of the key.
    """
    seen = hashlib.sha256()
    for path in paths:
        seen.update(f"\n{path}".encode())
        if path is None:
            continue
        fs, p = _open(spark, path)
        files = []
        if fs.exists(p):
            found = fs.listFiles(p, True)
            while found.hasNext():
                f = found.next()
                files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        seen.update("\n".join(sorted(files)).encode())
    return seen.hexdigest()[:24]
