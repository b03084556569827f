"""Session settings the jobs are written for, and where they may keep scratch data."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Column expressions are built without recording a stack trace for each of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", name: str = "tidemark", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the session comes from the submitter; the jobs read its
    settings and never build one of their own.
    """
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return one_row(spark, {}, schema).limit(0)


def one_row(spark: SparkSession, values: Mapping, schema: StructType) -> DataFrame:
    """A row of literals; unlike a table made from Python data it needs no Python worker."""
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """Session settings for the length of a block, restored afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def qualify(spark: SparkSession, path: str) -> str:
    """``path`` with its filesystem, spelled as a listing spells it."""
    filesystem, hadoop = _filesystem(spark, path)
    return filesystem.makeQualified(hadoop).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything matching a pattern, is there."""
    filesystem, hadoop = _filesystem(spark, path)
    return bool(filesystem.globStatus(hadoop))


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless the path is there; whether it was written."""
    filesystem, hadoop = _filesystem(spark, path)
    exists_already = spark.sparkContext._jvm.org.apache.hadoop.fs.FileAlreadyExistsException
    try:
        out = filesystem.create(hadoop, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() == exists_already._fqn:
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


#: Stores whose files appear whole, when they are closed, and whose renames are copies.
OBJECT_STORES = ("s3a", "s3", "gs", "oss", "cosn")


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file so that it appears whole or not at all; whether it was not there yet.

    The text goes to a file beside it first, which then takes the name unless that is taken: by a link on a local disk,
    by a rename that refuses an existing target elsewhere. Object stores show no file before it is closed
    (where they offer it, conditional writes must be on).
    """
    filesystem, hadoop = _filesystem(spark, path)
    scheme = filesystem.getUri().getScheme()
    if scheme in OBJECT_STORES:
        return create_text(spark, path, text)
    aside = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}.tmp"
    if scheme == "file":
        here, there = (filesystem.pathToFile(_filesystem(spark, p)[1]).getPath() for p in (aside, path))
        os.makedirs(os.path.dirname(here), exist_ok=True)
        with open(here, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(here, there)
        except FileExistsError:
            return False
        finally:
            os.unlink(here)
        return True
    create_text(spark, aside, text)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(filesystem.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(_filesystem(spark, aside)[1], hadoop, _no_options(spark))
    except Py4JJavaError as error:
        filesystem.delete(_filesystem(spark, aside)[1], False)
        if error.java_exception.getClass().getName() == fs.FileAlreadyExistsException._fqn:
            return False
        raise
    return True


def _no_options(spark: SparkSession):
    """An empty array of rename options: an existing target is refused."""
    option = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    return spark.sparkContext._jvm.java.lang.reflect.Array.newInstance(option, 0)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    filesystem, hadoop = _filesystem(spark, path)
    source = filesystem.open(hadoop)
    try:
        return bytes(source.readAllBytes()).decode("utf-8", "replace")
    finally:
        source.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly in a folder, in three calls whatever their number; nothing if it is missing."""
    filesystem, hadoop = _filesystem(spark, path)
    if not filesystem.exists(hadoop):
        return []
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(filesystem.listStatus(hadoop))
    folder = filesystem.makeQualified(hadoop).toString().rstrip("/")
    listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]  # folder/name,folder/name
    return [name.removesuffix(",") for name in listed.split(f"{folder}/")[1:]]


def replace_file(spark: SparkSession, path: str, target: str) -> None:
    """Move one file onto another's place."""
    filesystem, to = _filesystem(spark, target)
    filesystem.delete(to, False)
    filesystem.rename(_filesystem(spark, path)[1], to)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a folder, from the filesystem's own summary."""
    filesystem, hadoop = _filesystem(spark, path)
    return filesystem.getContentSummary(hadoop).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the caller has written itself."""
    filesystem, hadoop = _filesystem(spark, path)
    filesystem.delete(hadoop, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    local master may fall back to a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
