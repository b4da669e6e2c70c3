"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}
_tables: ContextVar[list[DataFrame] | None] = ContextVar("tables", default=None)


def build_session(app: str = "webgraph", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are tuned for.

    AQE re-plans joins and merges small shuffle partitions at run time, so
    ``spark.sql.shuffle.partitions`` should be set for the largest shuffle.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="webgraph-")
        folder = _local_dirs[app]
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet.

    All paths of one application lie under its id, so they can be dropped
    together once it has ended.
    """
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    A lost executor then costs a re-read, not a recomputation, values that a
    rerun could change (partition numbers) are settled, and later plans see the
    true size and only read the columns they use.
    """
    path = new_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    table = df.sparkSession.read.schema(schema).parquet(path)
    table.written_to = [path]
    if _tables.get() is not None:
        _tables.get().append(table)
    return table


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``cut_lineage`` writes inside are dropped at the end; what is to stay must be written by then."""
    token = _tables.set([])
    try:
        yield
    finally:
        drop_tables(*_tables.get())
        _tables.reset(token)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written table, or some partitions of one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_tables(*tables: DataFrame) -> None:
    """Deletes written tables, as ``cut_lineage`` gave them, once everything made from them is written too."""
    for table in tables:
        for path in getattr(table, "written_to", []):
            drop_path(table.sparkSession, path)
