"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that ``settle`` has made and ``release`` has not yet removed.
_settled: list[str] = []
#: Whether Spark removes a query's shuffle files when it ends, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(
    app_name: str = "depotlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with UTC clocks and adaptive execution.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the cluster's own values
    apply and adaptive execution merges or splits the shuffle partitions by size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session, where there are no other machines, may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="depotlens-checkpoint-"))
    return context.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let MLlib checkpoint into the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, which ``release`` removes."""
    path = f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _settled.append(path)
    return path


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files as soon as they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, **options: str) -> DataFrame:
    """Write a frame to Parquet in the shared folder, with the writer's options, and read it from there.

    For results that several later steps read: they are computed once, survive the loss of executors,
    and carry their true size, by which Spark picks join strategies. Nothing reads the shuffle files of the
    write again, so they go when it ends. ``release`` removes the rest.
    """
    target = scratch_folder(df.sparkSession, "settled")
    with without_leftovers(df.sparkSession):
        df.write.options(**options).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def release(spark: SparkSession) -> None:
    """Remove what this process has settled, at the end of a flow whose results are stored or shown."""
    while _settled:
        _remove(spark, _settled.pop())


def discard(*frames: DataFrame) -> None:
    """Remove settled frames that nothing will read again."""
    for df in frames:
        files = df.inputFiles()
        for path in [p for p in _settled if any(f"/{p.rsplit('/', 1)[1]}/" in file for file in files)]:
            _settled.remove(path)
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
