"""Exact paths looked up through Spark's file index."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

LOCAL = "^file:/+"  # local files are listed with one slash or three


def qualified(spark: SparkSession, place: str) -> str:
    """A path with its scheme, as files below it are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def uri(spark: SparkSession, place: str) -> str:
    return re.sub(LOCAL, "file:/", spark._jvm.org.apache.hadoop.fs.Path(place).toUri().toString())


def leaf_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """(URI, bytes) of the files that the paths name or that lie below them, in order.

    The index looks paths up in parallel, as a job if they are many, and passes over missing ones; nothing beside them is
    listed, and contents stay unread. Files whose names begin with ``_`` or ``.`` are left out.
    """
    if not paths:
        return []
    jvm = spark._jvm
    scala, datasources = jvm.org.apache.spark.api.python.PythonUtils, jvm.org.apache.spark.sql.execution.datasources
    none, session = jvm.scala.Option.empty(), spark._jsparkSession
    places = scala.toSeq([jvm.org.apache.hadoop.fs.Path(p) for p in paths])
    cache = datasources.FileStatusCache.getOrCreate(session)  # a new and empty one
    index = datasources.InMemoryFileIndex(session, places, scala.toScalaMap({}), none, cache, none, none)
    found = jvm.scala.jdk.javaapi.CollectionConverters.asJava(index.allFiles())
    return sorted({(re.sub(LOCAL, "file:/", f.getPath().toUri().toString()), f.getLen()) for f in found})
