"""Session defaults and the shared folder for tables that are written mid-plan."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where the split costs one more (pre-aggregated) shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
#: Bytes of shuffled rows that tasks read, unless the session says otherwise: a task that groups and
#: sorts rows along several steps needs some thirty times as much memory.
TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators are designed for on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get(TASK_BYTES[0], None) is None:
        spark.conf.set(*TASK_BYTES)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g", app: str = "cohortweave") -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in [*RUNTIME_CONF.items(), TASK_BYTES]:
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where that setting is absent, a local master (tests, a laptop) gets a temporary folder;
    on a cluster there is no folder that all executors are known to share, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _local_folder()
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder.

    It belongs to the innermost open `stage_tables`, or else to the process, and is deleted
    when its owner ends.
    """
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _OWNERS[-1].paths.append(path)
    return path


@dataclass(eq=False)
class StageTables:
    """The owner of stage tables: it knows their folders and deletes them, in whatever store they are."""

    paths: list[str] = field(default_factory=list)

    def keep(self, table: DataFrame) -> DataFrame:
        """Leaves a written table to the owner around this one."""
        path = table.stage_path
        self.paths.remove(path)
        _OWNERS[_OWNERS.index(self) - 1].paths.append(path)
        return table

    def delete(self, spark: SparkSession) -> None:
        hadoop = spark._jsc.hadoopConfiguration()
        while self.paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(hadoop).delete(path, True)


#: Owners from the process to the innermost open one.
_OWNERS: list[StageTables] = [StageTables()]


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[StageTables]:
    """Deletes the tables written inside when it ends, also by an error.

    Read what depends on them before the end, or `keep` a written result:

        with stage_tables(spark) as tables:
            docs = tables.keep(written(stage(docs), "stage"))
    """
    owner = StageTables()
    _OWNERS.append(owner)
    try:
        yield owner
    finally:
        _OWNERS.remove(owner)
        owner.delete(spark)


def drop_dead_shuffles(spark: SparkSession) -> None:
    """Has the driver's JVM collect garbage: Spark deletes a shuffle's files once nothing there refers to it.

    For steps between written tables whose shuffles are as large as their input.
    """
    spark._jvm.System.gc()


@atexit.register
def _delete_the_rest() -> None:
    """What nobody owned goes when the process ends while its session is still running."""
    with suppress(Exception):  # the store or the JVM may be gone before the process
        spark = SparkSession.getActiveSession()
        if spark is not None:
            _OWNERS[0].delete(spark)


@functools.cache
def _local_folder() -> str:
    """One temporary folder per process, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="cohortweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back.

    For results that several later steps read: they are computed once, survive lost
    executors, and their real size is known to the planner.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stage_path = path
    return table
