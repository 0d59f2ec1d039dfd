"""Session settings, the shared scratch folder, and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package relies on. All are runtime settings, so they can be
# applied to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs the grouping after the join a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Shuffled bytes that AQE puts together for one task, at most. They are compressed: a task that sorts both
# sides of a join and groups what it finds holds about 25 times as much, 1.7 GB from Spark's own 64 MB.
TASK_BYTES_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 16 << 20

FREE_SHUFFLES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def size_in_bytes(text: str) -> int:
    """A size as Spark's settings write it ("8m", "64MB", "1024"), in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on and return the same session.

    A session that asks for smaller tasks than TASK_BYTES keeps its own size.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    named = spark.conf.get(TASK_BYTES_KEY, None)
    if named is None or size_in_bytes(named) > TASK_BYTES:
        spark.conf.set(TASK_BYTES_KEY, f"{TASK_BYTES}b")
    return spark


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # Recording the Python call site of every column expression triples plan-building time.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder: on a cluster such a folder
    exists on one machine and is lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    already_set = context._jsc.sc().getCheckpointDir()
    if already_set.isDefined():
        return already_set.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tidemill-")
    context.setCheckpointDir(fallback)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing `df` to the shared folder and reading it back.

    A written Parquet table keeps column pruning and file statistics, survives the loss of
    executors, and is computed once however many branches read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[table] = path
    return table


_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote; no frame that is still to run may read them."""
    for table in tables:
        spark, path = table.sparkSession, _WRITTEN.pop(table)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are planned and run inside leave no shuffle files, which else stay until the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES_KEY, None)
    spark.conf.set(FREE_SHUFFLES_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES_KEY) if before is None else spark.conf.set(FREE_SHUFFLES_KEY, before)
