"""Versioned descriptions in a folder of the shared file system: one rename makes a version current.

A version is a file ``versions/<number>``. It is written beside, then renamed to the next number; a rename does not replace a file, so of two
writers that started from the same version one fails. Readers take the highest number and never see a part of a version.
"""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer published the version after the one this writer started from."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    fs, p = file_system(spark, f"{path}/versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def read(spark: SparkSession, path: str, version: int) -> str:
    fs, p = file_system(spark, f"{path}/versions/{version:012d}")
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, text) of the newest version."""
    have = versions(spark, path)
    return (have[-1], read(spark, path, have[-1])) if have else None


def publish(spark: SparkSession, path: str, text: str, after: int | None = None) -> int:
    """Make ``text`` the version that follows ``after`` (by default the newest); its number."""
    have = versions(spark, path)
    number = (have[-1] if have else 0) + 1 if after is None else after + 1
    fs, folder = file_system(spark, f"{path}/versions")
    fs.mkdirs(folder)
    _, staged = file_system(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    _, target = file_system(spark, f"{path}/versions/{number:012d}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        _rename(spark, staged, target)
    except Exception as e:
        fs.delete(staged, False)
        if fs.exists(target):
            raise Conflict(f"version {number} of {path} was published by another writer") from e
        raise
    return number


def _rename(spark: SparkSession, source, target) -> None:
    """A rename that fails if the target exists."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    none = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
    context.rename(source, target, none)
