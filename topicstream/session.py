"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Planner settings the jobs in this package are written for. All are run-time settings, so they
# can also be applied to a session that already exists.
PLANNER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where the following aggregation then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # what a finished query has shuffled goes with it, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_roots: dict[str, str] = {}
_staging: ContextVar[str | None] = ContextVar("staging", default=None)


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("topicstream")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in PLANNER_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster a machine-local
    folder would lose its content with the machine, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots and spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()  # set on the context, for all executors to see
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="topicstream-")
    return _local_roots[app]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run; nothing that exists is ever reused or deleted."""
    return f"{_staging.get() or shared_root(spark) + '/topicstream'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged_under(folder: str) -> Iterator[None]:
    """All tables staged inside go below ``folder``, lineage cuts included, so that they can be expired together."""
    token = _staging.set(folder)
    try:
        yield
    finally:
        _staging.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: whatever is still needed of them must be stored under a path from outside."""
    folder = new_run_dir(spark, "scratch")
    try:
        with staged_under(folder):
            yield
    finally:
        remove_folder(spark, folder)


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it lies in, as Spark sees them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    target, files = hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory()) if files.exists(target) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    target, files = hadoop_path(spark, path)
    files.delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative jobs restart from storage when an executor is lost."""
    spark = df.sparkSession
    if _staging.get():
        return staged_table(df, "cut")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def staged_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cut lineage plus real table sizes."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="topicstream-")) / "topicstream"), "zip", root, "topicstream"
    )
    spark.sparkContext.addPyFile(archive)  # Spark itself copies the archive to the executors
    _shipped.add(app)
