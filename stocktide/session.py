"""Session helpers: a builder for local work and intermediate tables in shared storage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders written inside each open `released_tables` block, the innermost last.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def build_session(
    name: str = "stocktide", master: str | None = None, **conf: str
) -> SparkSession:
    """Create a session with adaptive execution and UTC dates.

    `master` is left to spark-submit unless given. Extra settings win over the defaults.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.scheduler.mode": "FAIR",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def on_one_machine(spark: SparkSession) -> bool:
    return bool(re.match(r"local(\[|$)", spark.conf.get("spark.master", "")))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, reachable from every executor.

    It is the one named in `spark.checkpoint.dir`. Without one it lies in the SQL warehouse if that is a folder
    all machines reach: one of another file system than the local one, or any where Spark runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith(("/", "file:")) or ":/" not in warehouse
    if local and not on_one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return f"{warehouse}/_intermediate"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(
    df: DataFrame, partition_by: Sequence[str] = (), keep: bool = False
) -> DataFrame:
    """Write `df` to the shared folder and return a scan of the written table.

    A lost executor then costs a re-read, not the whole job, and every later pass reads only the
    columns it needs. `partition_by` gives each value its own folder, for jobs that read one value.
    Inside `released_tables` the table goes at the end of the block; with `keep` it outlives it.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    blocks = _blocks.get()[: -1 if keep else None]
    if blocks:
        blocks[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` in the checkpoint folder, its partitions and the order of its rows as they are, and the folder to delete.

    `cut_lineage` reads files back in splits of another number and order; this is for work that depends on them.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(df.sparkSession).rstrip('/')}/checkpoints")
    stored = df.checkpoint()
    return stored, stored._jdf.queryExecution().logical().rdd().getCheckpointFile().get()


@contextmanager
def released_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at its end the tables that `cut_lineage` writes inside the block.

    Only frames that read kept tables may leave the block. A kept table belongs to the block
    around this one, if there is any.
    """
    paths: list[str] = []
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(token)
        for path in paths:
            delete_folder(spark, path)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
