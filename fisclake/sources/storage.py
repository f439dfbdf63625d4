"""What lies in storage: files and partitions as DataFrames, and the few folder operations jobs need."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder; asks the name node, lists nothing."""
    filesystem, hadoop_path = _filesystem(spark, path)
    return filesystem.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if there is no such folder."""
    filesystem, hadoop_path = _filesystem(spark, path)
    if not filesystem.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(hadoop_path) if status.isDirectory())


def files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per file: path, bytes, mtime. File contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return listing.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))


# Spark writes one file as `file:/a` here and as `file:///a` there.
_SCHEME = r"^([^:/]+):/+"


def read_path() -> Column:
    """The file a row was read from, as ``file_states`` spells it."""
    return F.regexp_replace("_metadata.file_path", _SCHEME, "$1:/")


def file_states(spark: SparkSession, df: DataFrame) -> set[tuple[str, int, int]]:
    """Path, bytes and modification time of each file that ``df`` reads."""
    states = set()
    for name in df.inputFiles():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        states.add((re.sub(_SCHEME, r"\1:/", name), status.getLen(), status.getModificationTime()))
    return states


def partition_value(name: str, path: str | Column = "path") -> Column:
    """Value of one partition column out of a file path; NULL outside such a partition."""
    return F.nullif(F.regexp_extract(path, rf"/{name}=([^/]*)/", 1), F.lit(""))


def partition_inventory(spark: SparkSession, path: str, names: Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """Per partition: number of files, bytes, newest modification time."""
    keyed = files(spark, path, glob).select("*", *(partition_value(name).alias(name) for name in names))
    return keyed.groupBy(*names).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("mtime").alias("mtime")
    )


def existing_partitions(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame | None:
    """The partitions a table has, from the listing alone; None if there is no table yet."""
    if not exists(spark, path):
        return None
    return files(spark, path).select(*(partition_value(name).alias(name) for name in names)).distinct()


def newest_folder(listing: DataFrame, depth: int = 1) -> DataFrame:
    """Per directory the name of its newest child folder; children sort by name (``yyyyMMdd``)."""
    parts = F.split("path", "/")
    folder = F.element_at(parts, -1 - depth)
    directory = F.concat_ws("/", F.slice(parts, 1, F.size(parts) - 1 - depth))
    return listing.groupBy(directory.alias("directory")).agg(F.max(folder).alias("newest"))


_ENTRY = "directory string, name string, folder boolean, bytes long"


def entries(spark: SparkSession, directories: Sequence[str]) -> DataFrame:
    """What lies directly in each of some directories, folders too, which a listing of files can't see when they are empty.

    One task per directory, by the file systems pyarrow knows; those it doesn't are asked from the driver, once per directory. A directory that
    isn't there has no entries.
    """
    named = spark.createDataFrame([(d,) for d in directories], "directory string")
    if not directories:
        return spark.createDataFrame([], _ENTRY)
    try:
        filesystems.FileSystem.from_uri(directories[0])
    except (ValueError, OSError):  # no path with a scheme, or none that pyarrow knows
        if not directories[0].startswith("/"):
            return spark.createDataFrame([(d, *entry) for d in directories for entry in _listed(spark, d)], _ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for directory in batch.column("directory").to_pylist():
                filesystem, root = filesystems.FileSystem.from_uri(directory)
                for info in filesystem.get_file_info(filesystems.FileSelector(root, allow_not_found=True)):
                    folder = info.type == filesystems.FileType.Directory
                    rows.append({"directory": directory, "name": info.base_name, "folder": folder, "bytes": 0 if folder else info.size})
            schema = pa.schema([("directory", pa.string()), ("name", pa.string()), ("folder", pa.bool_()), ("bytes", pa.int64())])
            yield pa.RecordBatch.from_pylist(rows, schema)

    return named.repartition(len(directories), "directory").mapInArrow(run, _ENTRY)


def _listed(spark: SparkSession, directory: str) -> list[tuple[str, bool, int]]:
    filesystem, hadoop_path = _filesystem(spark, directory)
    if not filesystem.exists(hadoop_path):
        return []
    return [(status.getPath().getName(), status.isDirectory(), status.getLen()) for status in filesystem.listStatus(hadoop_path)]


def publish(spark: SparkSession, staged: str, path: str, prefix: str) -> None:
    """Move the finished files below ``staged`` into a table, each under its folder and with ``prefix`` before its name.

    Renames one file after another; run again after a failure, it goes on with what is still there.
    """
    filesystem, root = _filesystem(spark, staged)
    start = len(str(filesystem.makeQualified(root))) + 1
    listing = filesystem.listFiles(root, True)
    while listing.hasNext():
        source = listing.next().getPath()
        folder, _, name = str(source)[start:].rpartition("/")
        if name.startswith(("_", ".")):
            continue
        move(spark, str(source), f"{path}/{folder}/{prefix}{name}" if folder else f"{path}/{prefix}{name}")
    remove(spark, staged)


def publish_folders(spark: SparkSession, staged: str, path: str, depth: int) -> None:
    """Move the folders ``depth`` levels below ``staged`` into a table that lacks them: each is there whole or not at all.

    One that the table has is left there as it is. Lists folders only, level by level.
    """
    folders = [""]
    for _ in range(depth):
        folders = [f"{folder}/{name}" for folder in folders for name in child_folders(spark, staged + folder) if not name.startswith(("_", "."))]
    for folder in folders:
        if not exists(spark, path + folder):
            move(spark, staged + folder, path + folder)
    remove(spark, staged)


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty folder: a durable sign that something happened."""
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.mkdirs(hadoop_path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; a rename touches no data."""
    filesystem, source_path = _filesystem(spark, source)
    _, target_path = _filesystem(spark, target)
    if not filesystem.exists(target_path.getParent()):
        filesystem.mkdirs(target_path.getParent())
    if not filesystem.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.delete(hadoop_path, True)
