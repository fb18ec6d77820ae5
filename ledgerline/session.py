"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: every timestamp-to-date step depends on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by spark.checkpoint.dir.

    Only on a single machine may the setting be absent; then a folder is made up. On a
    cluster that would give every machine a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ledgerline/{spark.sparkContext.applicationId}"


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


# Folders this process has finished writing, with their schemas; the path names the application.
_complete: dict[str, T.StructType] = {}
_building = Lock()


def stored_once(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table kept under ``label`` for this application, built by its first reader.

    Meant for derived inputs that many queries share. A table lost in between is
    built again.
    """
    path = f"{work_folder(spark)}/{label}"
    with _building:
        if path in _complete:
            try:
                return spark.read.schema(_complete[path]).parquet(path)
            except AnalysisException as error:
                if not is_missing(error):
                    raise
        df = build()
        df.write.mode("overwrite").parquet(path, compression="zstd")
        _complete[path] = df.schema
        return spark.read.schema(df.schema).parquet(path)


_built: set[str] = set()
# Not the lock of stored_once: a build may read its tables from several threads.
_filling = Lock()


def built_once(spark: SparkSession, label: str, build: Callable[[str], None]) -> str:
    """The folder kept under ``label`` for this application, filled by its first user. A build that
    fails leaves a folder that nobody is told of."""
    path = f"{work_folder(spark)}/{label}"
    with _filling:
        if path not in _built or not folder_exists(spark, path):
            delete_folder(spark, path)
            build(path)
            _built.add(path)
    return path


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Run independent jobs at the same time; short ones then fill the gaps of long ones."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [future.result() for future in [pool.submit(step) for step in steps]]


PART_WRITERS = 64


def several_writers(spark: SparkSession) -> None:
    """Let a task keep a file open for each of some parts, so that it need not sort its rows by part; rows of
    parts beyond these are sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    if int(spark.conf.get(name, "0")) < PART_WRITERS:
        spark.conf.set(name, str(PART_WRITERS))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the work folder and read it back.

    Cuts the lineage for frames used more than once. The copy sits in shared
    storage, so a lost executor costs a re-read and not a recomputation. It stays
    until ``release`` is called.
    """
    spark = df.sparkSession
    path = temporary_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_TEMPORARY = "temporary"


def temporary_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name among the temporary copies, which go with the application at the latest."""
    top = f"{work_folder(spark)}/{_TEMPORARY}"
    if top not in _leaving:
        folder = spark._jvm.org.apache.hadoop.fs.Path(top)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
        _leaving.add(top)
    return f"{top}/{label}-{uuid.uuid4().hex}"


_leaving: set[str] = set()


def release(spark: SparkSession) -> None:
    """Delete everything ``materialize`` has written in this application.

    For the end of a job, when its results are stored elsewhere: frames read from
    the copies cannot be read afterwards.
    """
    delete_folder(spark, f"{work_folder(spark)}/{_TEMPORARY}")


def _place(spark: SparkSession, path: str):
    """A path and its file system, whatever that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that is absent is fine."""
    place, fs = _place(spark, path)
    fs.delete(place, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is absent."""
    place, fs = _place(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it is absent."""
    place, fs = _place(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isFile()] if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it is absent."""
    place, fs = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def place_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small new file in place as a whole; False if there is one of that name already."""
    place, fs = _place(spark, path)
    aside, _ = _place(spark, f"{path}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, place, none)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if not fs.exists(place):
            raise error
        return False
    return True


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
