"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_scratch: list[str] = []  # paths that scratch_path gave out and nothing has deleted yet


def local_session(cpus: int | str = 8, name: str = "millrace") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder: on a cluster such a folder would be lost together with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call returns."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the staged and scratch tables made inside on leaving; frames that read them must be used up by then.

    Checkpoints of ``stage`` are Spark's own: ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes them.
    """
    before = len(_scratch)
    try:
        yield
    finally:
        paths, _scratch[before:] = _scratch[before:], []
        for path in paths:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame) -> DataFrame:
    """Compute a small frame once and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, compression: str | None = None) -> DataFrame:
    """The same for a large frame, as a table in the shared folder: later scans read only the columns they need."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that several jobs read in the executors' memory and on their disks, and let go of it on leaving.

    What a lost executor held is computed again; ``stage`` and ``stage_table`` write it to the shared folder instead.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
