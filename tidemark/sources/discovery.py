"""Listing in proportion to what has changed: a stored listing, and the time of every folder.

Adding, removing or replacing a file changes the time of its folder. Folders that hold folders are listed each time, which
gives the times of those within; a folder of files only is listed again if its time is another than the stored one, if it
was still young when it was listed last, or if a date in its path is not before the mark. The files of all other
folders come from the stored listing, which never passes through the driver; folders and their times do.

Writing into an existing file on a local disk, or into a store that has no times of folders, cannot be seen this way; there
the full listing (``list_files``) is the one to use.
"""

from __future__ import annotations

import re
import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import LISTING_SCHEMA
from tidemark.session import _filesystem, empty_table, exists, list_names, qualify, remove
from tidemark.sources.listing import listing_splits

_FOLDERS = "folder string, time bigint, leaf boolean"
_STATUS = re.compile(r"FileStatus\{path=(.*?); isDirectory=(true|false);.*?modification_time=(\d+);", re.S)
_DATE = re.compile(r"(?<!\d)(\d{4})-?(\d{2})-?(\d{2})(?!\d)")

#: A folder that changed so shortly before it was listed may have changed again at the same time, in milliseconds.
SETTLED = 5_000


class Found(NamedTuple):
    """A listing, and how many folders had to be listed for it."""

    files: DataFrame
    listed: list[str]


def _children(spark: SparkSession, folder: str) -> list[tuple[str, bool, int]]:
    """Path, whether it is a folder, and time of everything directly in a folder; three calls whatever their number."""
    filesystem, hadoop = _filesystem(spark, folder)
    text = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(filesystem.listStatus(hadoop))
    found = [(path, kind == "true", int(when)) for path, kind, when in _STATUS.findall(text)]
    return [f for f in found if not f[0].rsplit("/", 1)[1].startswith(("_", "."))]


def _snapshots(spark: SparkSession, store: str) -> list[str]:
    """Complete stored listings, newest first."""
    names = sorted(list_names(spark, store), reverse=True)
    return [f"{store}/{n}" for n in names if exists(spark, f"{store}/{n}/folders/_SUCCESS")]


def _dated_from(folder: str, source: str, since: str | None) -> bool:
    found = _DATE.findall(folder[len(source) :])
    return bool(since and found) and "-".join(found[-1]) >= since[:10]


def changed_listing(spark: SparkSession, source: str, store: str, since: str | None = None) -> Found:
    """``path, modificationTime, length`` of every file below ``source``, as of now, kept below ``store`` for the next time.

    ``since``: a day as ISO text; folders dated from then on are listed again in any case. A missing source is empty.
    """
    source = qualify(spark, source).rstrip("/")
    if not exists(spark, source):
        return Found(empty_table(spark, LISTING_SCHEMA), [])
    now = int(time.time() * 1000)
    stored = _snapshots(spark, store)
    known: dict[str, tuple[int, bool]] = {}
    if stored:
        for r in spark.read.schema(_FOLDERS).parquet(f"{stored[0]}/folders").toLocalIterator():
            known[r["folder"]] = r["time"], r["leaf"]
    filesystem, hadoop = _filesystem(spark, source)
    todo = [(source, filesystem.getFileStatus(hadoop).getModificationTime())]
    folders, listed, fresh = [], [], []
    while todo:
        folder, when = todo.pop()
        before = known.get(folder)
        if before and before[1] and before[0] == when and not _dated_from(folder, source, since):
            folders.append((folder, when, True))
            continue
        children = _children(spark, folder)
        listed.append(folder)
        inner = [(path, t) for path, is_folder, t in children if is_folder]
        todo += inner
        # One that may still change within the same tick of its clock is looked at again next time.
        folders.append((folder, when if now - when > SETTLED else -1, not inner))
        if any(not is_folder for _, is_folder, _ in children):
            fresh.append(folder)
    files = _files(spark, fresh)
    if stored:
        kept = spark.createDataFrame([(f,) for f in set(known) & ({f for f, *_ in folders} - set(listed))], "folder string")
        old = spark.read.parquet(f"{stored[0]}/files").join(kept, "folder", "left_semi")
        files = files.unionByName(old)
    place = f"{store}/{now:015d}-{uuid.uuid4().hex}"
    with listing_splits(spark):
        files.write.parquet(f"{place}/files")
    spark.createDataFrame(folders, _FOLDERS).write.parquet(f"{place}/folders")
    for old_place in stored[1:]:
        remove(spark, old_place)
    every = spark.read.schema(T.StructType([*LISTING_SCHEMA.fields, T.StructField("folder", T.StringType())]))
    return Found(every.parquet(f"{place}/files").drop("folder"), listed)


def _files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The files directly in some folders, listed by Spark in parallel; contents are not opened."""
    if not folders:
        return empty_table(spark, T.StructType([*LISTING_SCHEMA.fields, T.StructField("folder", T.StringType())]))
    from tidemark.functions.text import glob_literal

    rows = spark.read.format("binaryFile").load([f"{glob_literal(f)}/*" for f in folders])
    files = rows.select("path", "modificationTime", "length")
    return files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
