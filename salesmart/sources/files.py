"""Whole files of a directory tree, listed and read by the tasks.

Spark's file sources keep the status of every file on the driver, some
kilobytes each. Here the folders of a level are listed by tasks, what they find
is written, and the folders among it are the next level. The driver knows the
root and the number of levels only.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as files_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import work_dir

# Rows and bytes of the batches that tasks hand on.
BATCH_FILES, BATCH_BYTES = 4096, 4 << 20


def hidden(name: str, folder: bool) -> bool:
    """Names that Spark's file sources pass over."""
    odd = (name.startswith("_") and "=" not in name) or name.startswith(".")
    if not folder:
        return odd or name.endswith("._COPYING_")
    return (odd or name.endswith("._COPYING_")) and not name.startswith(("_common_metadata", "_metadata"))


def _entries(store: files_of.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, is a folder, bytes) of what lies in a folder; a local one is never held whole."""
    if not isinstance(store, files_of.LocalFileSystem):
        yield from ((e.base_name, e.type == files_of.FileType.Directory, e.size or 0) for e in store.get_file_info(files_of.FileSelector(folder)))
        return
    with os.scandir(folder) as found:
        for e in found:
            try:
                yield e.name, e.is_dir(), e.stat().st_size
            except FileNotFoundError:  # gone meanwhile, or a link to nothing
                continue


def _tasks(spark: SparkSession) -> int:
    return 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _located(spark: SparkSession, root: str) -> tuple[str, str] | None:
    """(the root as Spark names it, its URI for the tasks), if it is one folder of a store that tasks can open without Spark."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = store.makeQualified(path)
    scheme, authority, plain = path.toUri().getScheme(), path.toUri().getAuthority() or "", path.toUri().getPath()
    uri = f"{scheme}://{authority}{quote(plain)}"
    try:
        files_of.FileSystem.from_uri(uri)
    except (pa.ArrowException, OSError):
        return None
    return (path.toString(), uri) if store.exists(path) and store.getFileStatus(path).isDirectory() else None


def _listed(spark: SparkSession, uri: str) -> DataFrame:
    """name (below the root), folder, length of everything in the tree, from a table of its own for each level."""
    def run(batches):
        store, base = files_of.FileSystem.from_uri(uri)
        rows = []
        for batch in batches:
            for below in batch.column("name").to_pylist():
                for name, folder, length in _entries(store, f"{base}/{below}" if below else base):
                    if not hidden(name, folder):
                        rows.append((f"{below}/{name}" if below else name, folder, length))
                    if len(rows) == BATCH_FILES:
                        yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["name", "folder", "length"])
                        rows = []
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=["name", "folder", "length"])

    schema, at = "name string, folder boolean, length long", work_dir(spark, "listing")
    level, levels = spark.createDataFrame([("",)], "name string"), []
    while not level.isEmpty():
        levels.append(f"{at}/{len(levels)}")
        level.repartition(_tasks(spark), "name").mapInArrow(run, schema).write.parquet(levels[-1], compression="zstd")
        level = spark.read.schema(schema).parquet(levels[-1]).where("folder").select("name")
    return spark.read.schema(schema).parquet(*levels)


def whole_files(spark: SparkSession, root: str, max_bytes: int) -> DataFrame:
    """path, length and content of every file below ``root``, one row each; no content where it is longer than ``max_bytes``.

    Rows and paths are those of Spark's ``binaryFile`` source with recursive
    lookup. A store that only Spark can open is left to that source.
    """
    found = _located(spark, root)
    if found is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        small = F.col("length") <= F.lit(max_bytes)
        # the contents of larger files are not among the columns of their scan
        return files.where(small).select("path", "length", "content").coalesce(_tasks(spark)).unionByName(
            files.where(~small).select("path", "length", F.lit(None).cast("binary").alias("content")).coalesce(_tasks(spark)))
    top, uri = found

    def run(batches):
        store, base = files_of.FileSystem.from_uri(uri)
        rows, held = [], 0
        for batch in batches:
            for name, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                content = None
                if length <= max_bytes:
                    with store.open_input_stream(f"{base}/{name}") as stream:
                        content = stream.read()
                    held += len(content)
                rows.append((f"{top.rstrip('/')}/{name}", length, content))
                if len(rows) == BATCH_FILES or held >= BATCH_BYTES:
                    yield _contents(rows)
                    rows, held = [], 0
        if rows:
            yield _contents(rows)
    files = _listed(spark, uri).where("NOT folder AND length > 0").select("name", "length")
    return files.repartition(_tasks(spark), "name").mapInArrow(run, "path string, length long, content binary")


def _contents(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)],
                           names=["path", "length", "content"])
