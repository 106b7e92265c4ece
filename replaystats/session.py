"""Session settings and the shared folder for staged intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Correctness settings (time zone, ANSI) are pinned; the rest lets AQE size and
# split shuffle partitions at run time instead of guessing them up front.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where no partition of a join's smaller side is beyond this size, it is hashed and neither side sorted.
    # Measured at run time; below the advisory partition size (64 MB) the setting would have no effect.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "replaystats", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the pinned settings. Deployment settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the pinned settings to a session that somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


_fallback: str | None = None


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's checkpoint folder.

    Only a local-mode session may fall back to a temporary folder, because other
    machines could not read it.
    """
    global _fallback
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if _fallback is None:
        _fallback = tempfile.mkdtemp(prefix="replaystats-")
    return _fallback


# Staged tables lie in a folder of the job that made them, or, outside of one, of the process.
_RUN: ContextVar[str] = ContextVar("_RUN", default=f"replaystats-{uuid.uuid4().hex}")


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A staging folder of its own for what is staged inside, deleted at the end, also after a
    failure. Jobs that run side by side don't touch each other's staged tables."""
    token = _RUN.set(f"replaystats-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        clear_staged(spark)
        _RUN.reset(token)


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, in folders ``by`` some columns, and read it back.

    Used where one intermediate feeds several consumers. Unlike a cache it survives
    the loss of executors, and the read side still prunes columns and has exact size
    statistics, so the planner can choose broadcast joins from real sizes.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{_RUN.get()}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(parts: Iterable[DataFrame], name: str) -> DataFrame | None:
    """As :func:`stage`, for frames of one schema that are written one after the other to one folder; None without any."""
    first, path = None, f"{_RUN.get()}/{name}-{uuid.uuid4().hex}"
    for df in parts:
        first = df if first is None else first
        df.write.mode("append").parquet(f"{staging_root(df.sparkSession)}/{path}")
    if first is None:
        return None
    spark = first.sparkSession
    return spark.read.schema(first.schema).parquet(f"{staging_root(spark)}/{path}")


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Reads planned and run inside give a task thousands of small files, not the 32 of Spark's defaults, and a list of
    paths is looked up by a few tasks, not by one a path."""
    wanted = {
        "spark.sql.files.openCostInBytes": "65536",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def clear_staged(spark: SparkSession) -> None:
    """Delete the staged tables of the current scope. Call when no frame built on them is needed any more."""
    delete(spark, f"{staging_root(spark)}/{_RUN.get()}")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner would broadcast ``df``: its estimated size, exact for a staged table, is below
    the session's threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it lies."""
    target, system = _on_file_system(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _on_file_system(spark, path)
    return system.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    target, system = _on_file_system(spark, path)
    system.mkdirs(target)


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of the last change in milliseconds) of what lies directly in a folder."""
    target, system = _on_file_system(spark, path)
    if not system.exists(target):
        return []
    return [(f.getPath().getName(), f.getModificationTime()) for f in system.listStatus(target)]


def move(spark: SparkSession, url: str, folders: Sequence[str]) -> str | None:
    """Move a file into the first of ``folders`` where its name is free, or, if it is free in none, into
    the last one under a name of its own. ``url`` is percent-encoded, as Spark's readers give it.
    The new place, or None if the file could not be moved."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source = path(spark._jvm.java.net.URI(url))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    name = source.getName()
    stem, dot, ending = name.rpartition(".")
    free = [(f, name) for f in folders] + [(folders[-1], f"{stem or name}.{uuid.uuid4().hex}{dot}{ending if stem else ''}")]
    for folder, called in free:
        goal = path(path(folder), called)
        if system.exists(goal):
            continue
        if system.rename(source, goal):
            return goal.toString()
    return None


def _on_file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
