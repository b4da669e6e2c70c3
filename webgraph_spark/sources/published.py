"""Crawl tables whose batches appear whole and once (SNK-3).

A batch of rows for several tables is staged in folders of its own; nobody reads them yet. One manifest then names,
per table, the folder of every batch, and the rename that gives the manifest its version number publishes all tables of
the batch together. A writer that dies before the rename leaves folders no reader sees; a batch that is published again
takes the place of its earlier rows. Two writers cannot both make one version: the later reads the newer manifest and tries
again. Needs a file system whose rename does not replace an existing file and is atomic, as HDFS's.

    base/manifests/00000000000000000007.json    {"link": {"round-12": "staged/link/round-12-4f..."}, ...}
    base/staged/link/round-12-4f.../part-*.parquet
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webgraph_spark.schemas import TABLES
from webgraph_spark.session import drop_path

Manifest = dict[str, dict[str, str]]

ATTEMPTS = 50


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _folder(base: str, *names: str) -> str:
    return "/".join([base.rstrip("/"), *names])


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, time of its last change in seconds) of what is in a folder; none if there is no such folder."""
    where, files = _files(spark, folder)
    if not files.exists(where):
        return []
    return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in files.listStatus(where)]


def _versions(spark: SparkSession, base: str) -> list[int]:
    names = [name for name, _ in _listed(spark, _folder(base, "manifests"))]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))


def _manifest_path(base: str, version: int) -> str:
    return _folder(base, "manifests", f"{version:020d}.json")


def _load(spark: SparkSession, base: str, version: int) -> Manifest:
    where, files = _files(spark, _manifest_path(base, version))
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, base: str) -> tuple[int, Manifest]:
    """The newest version and its content; version 0 is empty."""
    versions = _versions(spark, base)
    return (versions[-1], _load(spark, base, versions[-1])) if versions else (0, {})


def _add_version(spark: SparkSession, base: str, version: int, content: Manifest) -> bool:
    """Whether this writer made the version; False if another one was first."""
    folder = _folder(base, "manifests")
    hidden, files = _files(spark, _folder(folder, f".{uuid.uuid4().hex}"))
    files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
    stream = files.create(hidden, False)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    target, _ = _files(spark, _manifest_path(base, version))
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(hidden), context.makeQualified(target), no_options)
    except Py4JJavaError as failed:
        if not files.exists(target):
            raise
        del failed
        files.delete(hidden, False)
        return False
    return True


def stage(rows: Mapping[str, DataFrame], base: str, batch: str) -> dict[str, str]:
    """Writes the rows of a batch, by table, where no reader looks; gives the folder of each table.

    Columns follow the table's schema; missing ones are NULL, others are left out.
    """
    staged = {}
    for table, df in rows.items():
        columns = [
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table]
        ]
        staged[table] = f"staged/{table}/{batch}-{uuid.uuid4().hex}"
        df.select(columns).write.parquet(_folder(base, staged[table]))
    return staged


def publish(spark: SparkSession, base: str, batch: str, staged: Mapping[str, str]) -> int:
    """Makes the staged folders the rows of ``batch``, all at once; gives the version.

    What the batch had in these or other tables before is no longer read.
    """
    for _ in range(ATTEMPTS):
        version, content = manifest(spark, base)
        for batches in content.values():
            batches.pop(batch, None)
        for table, folder in staged.items():
            content.setdefault(table, {})[batch] = folder
        if _add_version(spark, base, version + 1, content):
            return version + 1
    raise RuntimeError(f"{ATTEMPTS} other writers were first in {base}")


def commit(spark: SparkSession, rows: Mapping[str, DataFrame], base: str, batch: str) -> int:
    """Stages and publishes a batch; a second call with the same batch replaces the first one's rows."""
    return publish(spark, base, batch, stage(rows, base, batch))


def read_published(
    spark: SparkSession, base: str, table: str, version: int | None = None, without: str | None = None
) -> DataFrame:
    """The rows of a table in the newest version, or in an older one that is still kept.

    ``without``: a batch that is left out. A batch that is admitted against the table (unique keys, byte budgets) must
    not meet its own earlier rows, or its second run would admit nothing and publish that.
    """
    content = manifest(spark, base)[1] if version is None else _load(spark, base, version)
    folders = [_folder(base, folder) for batch, folder in sorted(content.get(table, {}).items()) if batch != without]
    if not folders:
        return spark.createDataFrame([], TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(*folders)


def vacuum(spark: SparkSession, base: str, keep: int = 2, older_than: float = 86400.0) -> list[str]:
    """Deletes all but the newest ``keep`` manifests, and the folders that none of these names; gives the folders.

    Folders changed within ``older_than`` seconds stay: their writer may be about to publish them.
    """
    versions = _versions(spark, base)
    kept, gone = versions[-keep:], versions[:-keep]
    named = {folder for v in kept for batches in _load(spark, base, v).values() for folder in batches.values()}
    before = time.time() - older_than
    dropped = []
    for table, _ in _listed(spark, _folder(base, "staged")):
        for name, changed in _listed(spark, _folder(base, "staged", table)):
            folder = f"staged/{table}/{name}"
            if folder not in named and changed <= before:
                drop_path(spark, _folder(base, folder))
                dropped.append(folder)
    for version in gone:
        drop_path(spark, _manifest_path(base, version))
    return dropped
