"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "8",  # records are not sorted to part good and rejected ones
}

#: Spark's setting under which a query removes its shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "bizlens", **conf: str) -> SparkSession:
    """A session with this library's defaults; sizing stays with the caller or ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only on a local master, where the machine is the
    whole cluster; on any other master a missing setting is an error.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="bizlens-")
    return _local_scratch[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends meanwhile go at once, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` wrote, once all that was made of them is written; other tables stay."""
    for table in tables:
        if table is None:
            continue
        spark = table.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(scratch_root(spark))
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        inside = f"{files.makeQualified(root).toUri().getPath()}/"
        for folder in {hadoop.Path(name).getParent().toUri().getPath() for name in table.inputFiles()}:
            if folder.startswith(inside):
                files.delete(hadoop.Path(folder), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)
