"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Names the folder that all executors share; Spark allows it to be set only when a session starts.
SHARED = "spark.checkpoint.dir"
#: Removes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gaugeworks") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own.

    Where Spark's defaults name no shared folder, it gets a temporary one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Hash instead of sort where every shuffled partition is known to be small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    if not spark.sparkContext.getConf().contains(SHARED):  # fixed when a session starts, so start it again
        spark.stop()
        spark = builder.config(SHARED, tempfile.mkdtemp(prefix="gaugeworks-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get(SHARED, None) or spark.sparkContext.getConf().get(SHARED, None)
    if not folder:
        raise ValueError(f"start the session with {SHARED} set to a folder shared by all executors")
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/gaugeworks/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the application's intermediate tables; for the end of a job, when no result reads them any more."""
    remove(spark, scratch_folder(spark))


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage and survives lost executors; unlike a checkpoint of rows, later reads
    still prune columns and push filters down. The shuffle files of the write go with it.
    """
    path = path or _scratch(df.sparkSession, label)
    conf = df.sparkSession.conf
    given = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
        if (copies := _copies.get()) is not None:
            copies.append(path)
    finally:
        if given is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, given)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Copies of the innermost :func:`passing` block.
_copies: ContextVar[list[str] | None] = ContextVar("copies", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """The last copy that :func:`written` makes inside is the block's result; all before it are removed when the block is over."""
    token = _copies.set(copies := [])
    try:
        yield
    except BaseException:
        copies.append("")
        raise
    finally:
        _copies.reset(token)
        for path in filter(None, copies[:-1]):
            remove(spark, path)
    if (outer := _copies.get()) is not None:
        outer.extend(copies[-1:])


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`written`, for use within one step: the copy is removed when the step is over."""
    path = _scratch(df.sparkSession, label)
    try:
        yield written(df, label, path)
    finally:
        remove(df.sparkSession, path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a location, as the JVM sees them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_gaugeworks_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if not package.is_dir():  # imported from an archive that was submitted with the application
        return
    base = Path(tempfile.mkdtemp(prefix="gaugeworks-")) / package.name
    sc.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
    sc._gaugeworks_shipped = True
