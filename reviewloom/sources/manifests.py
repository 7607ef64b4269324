"""Numbered entries that many writers may add at once.

An entry is one small JSON file, named by its number in a folder. It is written under a name of its own and then
put in place in one step that fails if the number is taken, so every number has one writer, and readers see an
entry as a whole or not at all.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_DIGITS = 10


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with ``text``; False, without a change, if there is one already."""
    system, target = _system(spark, path), _path(spark, path)
    own = _path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    system.mkdirs(target.getParent())
    out = system.create(own, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if system.getScheme() == "file":
            # A local rename replaces what is there; a second link to a file does not.
            none = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            here, there = (
                jvm.java.nio.file.Paths.get(system.makeQualified(p).toUri().getPath(), none) for p in (own, target)
            )
            jvm.java.nio.file.Files.createLink(there, here)
        else:
            conf = spark._jsparkSession.sessionState().newHadoopConf()
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(system.makeQualified(own), system.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        if system.exists(own):
            system.delete(own, False)


def newest(spark: SparkSession, folder: str) -> int:
    """The highest number in ``folder``, 0 if there is none."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return 0
    names = [status.getPath().getName() for status in system.listStatus(_path(spark, folder))]
    return max((int(n[:_DIGITS]) for n in names if n[:_DIGITS].isdigit()), default=0)


def publish(spark: SparkSession, folder: str, entry: dict, first: int = 1) -> int:
    """Adds ``entry`` under the next free number from ``first`` on; the entry holds it as ``version``."""
    version = max(newest(spark, folder) + 1, first)
    while not put_if_absent(spark, f"{folder}/{version:0{_DIGITS}d}.json", json.dumps({**entry, "version": version})):
        version += 1
    return version


def entries(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All entries below a folder or pattern of folders; files being written are hidden names."""
    try:
        return spark.read.schema(schema).json(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
