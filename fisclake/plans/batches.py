"""Several batches in one run: one that fails does not stop the others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.operators.gates import DuplicateBatchError
from fisclake.operators.sinks import VerificationError
from fisclake.plans.load import Target, load
from fisclake.registry import DocumentType
from fisclake.sources.storage import child_folders, exists, file_states, read_path


_FILES = "batch string, rule string, path string, bytes long, mtime long"


@dataclass(frozen=True)
class Batch:
    """One inbox folder of one document type. Several batches may read the same inbox, each for a table of its own: headers, then items."""

    kind: DocumentType
    path: str
    target: Target
    where: str | None = None
    clean: bool = False


def batch_name(batch: Batch, files: Iterable[tuple[str, int, int]]) -> str:
    """What some files of an inbox are called among the signs of its table: by path, size and modification time of each."""
    return hashlib.sha256(f"{sorted(files)}|{batch.where or ''}".encode()).hexdigest()[:20]


def begun(spark: SparkSession, batch: Batch, present: set[tuple[str, int, int]]) -> dict[str, set[tuple[str, int, int]]]:
    """The files of each batch of this table that is ready or done. What was only staged counts for nothing: none of it is in the table.

    Of the batches that are done only the files that are ``present`` reach the driver, not all that were ever loaded.
    """
    signs = batch.target.signs
    folders = set(child_folders(spark, signs))
    over = [name.removesuffix("-done") for name in child_folders(spark, f"{signs}_rejected") if name.endswith("-done")]
    noted = [f"{signs}/{name}" for name in folders if name.endswith("-files") and name.replace("-files", "-ready") in folders]
    found: dict[str, set[tuple[str, int, int]]] = {}
    if noted:
        listed = spark.read.schema(_FILES).parquet(*noted).filter(F.col("rule") == (batch.where or ""))
        here = spark.createDataFrame(sorted(present), "path string, bytes long, mtime long")
        finished = spark.createDataFrame([(name,) for name in over], "batch string")
        cut_off = listed.join(finished, "batch", "left_anti")
        known = listed.join(finished, "batch", "left_semi").join(here, ["path", "bytes", "mtime"], "left_semi")
        for row in cut_off.unionByName(known).collect():
            found.setdefault(row.batch, set()).add((row.path, row.bytes, row.mtime))
    return found


def load_new_files(spark: SparkSession, batch: Batch) -> None:
    """Load the files of an inbox that no batch has brought yet; one that was cut off comes first, with the same files as before."""
    signs = batch.target.signs
    former = hashlib.sha256(f"{batch.path}|{batch.where or ''}".encode()).hexdigest()[:20]
    if exists(spark, f"{signs}/{former}-ready"):
        raise VerificationError(f"{batch.path} was loaded when its files were not noted: which of them the table has is not known")
    inbox = spark.read.parquet(batch.path)
    present = file_states(spark, inbox)
    new = set(present)

    def load_files(name: str, files: set[tuple[str, int, int]]) -> None:
        part = inbox if files == present else inbox.filter(read_path().isin([path for path, _, _ in files]))
        load(part, batch.kind, batch.target, where=batch.where, name=name, clean=batch.clean)

    for name, files in begun(spark, batch, present).items():
        if not exists(spark, f"{signs}_rejected/{name}-done") and files & present:
            if not files <= present:
                raise VerificationError(f"{batch.path}: a batch was cut off, and some of its files are gone: {sorted(files - present)[:3]}")
            load_files(name, files)
        new -= files
    if new:
        name = batch_name(batch, new)
        noted = spark.createDataFrame([(name, batch.where or "", *file) for file in sorted(new)], _FILES)
        noted.coalesce(1).write.mode("overwrite").parquet(f"{signs}/{name}-files")
        load_files(name, new)


def load_batches(spark: SparkSession, batches: Iterable[Batch]) -> DataFrame:
    """Load each batch and report it: table, path, outcome (loaded, absent or failed) and the reason of a failure.

    A batch that fails stays in its inbox and can be loaded again; nothing of it was written if the gate refused it. The files
    of an inbox are known by path, size and modification time, and each is loaded once: a second run, or one after a failure half-way,
    adds what is still lacking, and files delivered since then are a batch of their own.
    """
    report = []
    for batch in batches:
        outcome, reason = "loaded", None
        if not exists(spark, batch.path):
            outcome = "absent"
        else:
            try:
                load_new_files(spark, batch)
            except (DuplicateBatchError, VerificationError, PySparkException, Py4JError, OSError) as error:
                outcome, reason = "failed", str(error)
        report.append((batch.kind.silver, batch.path, outcome, reason))
    return spark.createDataFrame(report, "table string, path string, outcome string, reason string")
