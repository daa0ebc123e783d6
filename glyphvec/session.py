"""Session, file-system and intermediate-table helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[tuple[str, str]] = set()
#: Tables that ``materialise`` wrote since the innermost ``passing_tables`` began.
_passing: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("passing", default=None)


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local benchmark; on a cluster use the one that is there."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("glyphvec")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession, *folders: str) -> None:
    """Send this package, and further package folders, to the executors as ``--py-files`` would."""
    context = spark.sparkContext
    for package in (os.path.dirname(os.path.abspath(__file__)), *folders):
        if (context.applicationId, package) in _shipped:
            continue
        name = os.path.basename(package)
        archive = os.path.join(tempfile.mkdtemp(prefix="glyphvec-"), f"{name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in Path(package).rglob("*.py"):
                out.write(path, Path(name) / path.relative_to(package))
        context.addPyFile(archive)
        _shipped.add((context.applicationId, package))


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, below the shared folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="glyphvec-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/glyphvec/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true size of the table, so
    that Spark itself decides whether it is small enough to broadcast. ``options`` are the writer's.
    """
    path = work_path(df.sparkSession, label)
    if (passing := _passing.get()) is not None:
        passing.append((df.sparkSession, path))
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables() -> Iterator[None]:
    """Tables that ``materialise`` writes inside go at the end, whether the job succeeded or not.

    No frame that reads them may leave the block; what the job returns is written first, see ``settled``.
    """
    passing: list[tuple[SparkSession, str]] = []
    token = _passing.set(passing)
    try:
        yield
    finally:
        _passing.reset(token)
        for spark, path in passing:
            fs, hpath = _hadoop_path(spark, path)
            fs.delete(hpath, True)


def settled(label: str) -> Callable:
    """For a job that returns a frame: its result becomes a table, then the tables on its way go.

    The result itself belongs to the job around it, which may let it go in turn.
    """

    def wrap(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(job)
        def run(*args, **kwargs) -> DataFrame:
            around = _passing.get()
            with passing_tables():
                found = job(*args, **kwargs)
                token = _passing.set(around)
                try:
                    return materialise(found, label)
                finally:
                    _passing.reset(token)

        return run

    return wrap


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_path(spark, path)
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def file_uri(spark: SparkSession, path: str) -> str:
    """Absolute URI of ``path``; a local one begins with ``file:/``, one slash."""
    fs, hpath = _hadoop_path(spark, path)
    uri = fs.makeQualified(hpath).toUri().toString().rstrip("/")
    return re.sub("^file:/+", "file:/", uri)


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file tree if it is a ``file:`` one, which Spark, too, needs on every machine; else None."""
    fs, hpath = _hadoop_path(spark, path)
    uri = fs.makeQualified(hpath).toUri()
    return uri.getPath().rstrip("/") if uri.getScheme() == "file" else None


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop_path(spark, path)
    fs.mkdirs(hpath)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> str:
    """Write one small file in the file system of ``path``; returns the path."""
    fs, hpath = _hadoop_path(spark, path)
    out = fs.create(hpath)
    out.write(content)
    out.close()
    return path


def copy_hidden(spark: SparkSession, folder: str, suffix: str) -> tuple[str, list[tuple[str, str, str]]] | None:
    """Copies of the files in ``folder`` that Spark's readers pass over because of their first letter.

    Returns the folder of the copies and (name of the copy, file URI, path) of each; None if there are
    none. The bytes go from file to file; such files are few.
    """
    fs, hpath = _hadoop_path(spark, folder)
    # Picked in the JVM: names of a large folder do not come to Python one by one.
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobFilter("[._]*")
    found = [s.getPath() for s in fs.listStatus(hpath, hidden) if s.isFile()]
    found = [p for p in found if p.getName().lower().endswith(suffix)]
    if not found:
        return None
    target = work_path(spark, "hidden")
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = []
    for i, path in enumerate(found):
        to_fs, to = _hadoop_path(spark, f"{target}/{i}{suffix}")
        copy(fs, path, to_fs, to, False, conf)
        uri = re.sub("^file:/+", "file:/", path.toUri().toString())
        names.append((f"{i}{suffix}", uri, path.toString()))
    return target, names


def count_files(df: DataFrame) -> int:
    """Number of files that a scan has listed, with and without bytes; no name comes to Python."""
    return len(df._jdf.inputFiles())


def listed_files(df: DataFrame) -> DataFrame:
    """(value) names of the files that a scan has listed, fetched at once."""
    # They are URIs: none holds a line break.
    names = df.sparkSession.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", df._jdf.inputFiles())
    return df.sparkSession.createDataFrame([(name,) for name in names.split("\n")], "value STRING")


def runs_python(df: DataFrame) -> bool:
    """Whether reading ``df`` again would run Python code again, such as an encoder."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return bool(re.search("InArrow|InPandas|InPython|EvalPython|PythonUDTF|UserDefined", plan))


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate; for a plain file scan, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def widen(df: DataFrame) -> DataFrame:
    """``df`` with a partition per core, if its scan has fewer; for CPU-heavy work on few input splits.

    A large input has splits enough and is never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
