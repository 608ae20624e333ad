"""Session helpers: defaults, a shared scratch folder, and written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Few rows per Arrow batch keep Python memory flat when texts are long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app_name: str = "loomvec", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set SQL options for the actions inside the block and restore them after."""
    wanted = {f"spark.sql.{name}": value for name, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without a name a local folder is made in local mode only. Elsewhere that is an error: executors
    would write to disks of their own, and tables would read back empty.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    is_local = re.fullmatch(r"local(\[.*\])?", context.master) is not None
    if not named:
        if not is_local:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="loomvec-")
        context.setCheckpointDir(named)
    named = named.rstrip("/")
    if not is_local and (context.applicationId, named) not in _PROBED:
        _probe(spark, named)
        _PROBED.add((context.applicationId, named))
    return named


_PROBED: set[tuple[str, str]] = set()


def _probe(spark: SparkSession, folder: str) -> None:
    """Once per application: rows that many tasks write there can all be read back."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    path = f"{folder}/loomvec/{spark.sparkContext.applicationId}/probe-{uuid.uuid4().hex}"
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    found = spark.read.schema("id long").parquet(path).count()
    if found != tasks:
        raise ValueError(f"{folder} is not shared: {found} of {tasks} rows written there were read back")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/loomvec/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table of this application."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once its results are written."""
    files, where = file_system(spark, _own_folder(spark))
    files.delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The copy outlives lost executors, fixes every non-deterministic choice made
    upstream, and gives the planner exact sizes: later joins broadcast it only
    when the files are below ``spark.sql.autoBroadcastJoinThreshold``. Shuffle files of the
    write go when it ends; long operators would otherwise keep those of all their steps.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with session_conf(spark, **{"classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete tables that :func:`materialise` wrote, once nothing reads them any more."""
    for df in written:
        files, where = file_system(df.sparkSession, df._written_to)
        files.delete(where, True)
