"""The load of one batch: gate, clean-up, route, parse, write."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION, partition_key
from fisclake.functions.text import clean_xml
from fisclake.operators.audit import count_by
from fisclake.operators.gates import require_unique
from fisclake.operators.keytables import KeyTable, add_keys
from fisclake.operators.parse import Filing, accepted_filing, item_filing, names_in_use, read_once, rejected
from fisclake.operators.sinks import new_items, write_partitioned
from fisclake.registry import DOCUMENTS, ITEMS, XML, DocumentType
from fisclake.sources.scans import read_table
from fisclake.sources.storage import exists, remove
from fisclake.streaming.incremental import append_batch


@dataclass(frozen=True)
class Target:
    """Where one document type goes, and where what cannot be filed is kept."""

    path: str

    @property
    def rejected(self) -> str:
        return f"{self.path}_rejected"

    @property
    def signs(self) -> str:
        return f"{self.path}_loaded"


def cleaned(bronze: DataFrame, kind: DocumentType, xml: str = XML) -> DataFrame:
    """The same rows with their XML as the source should have delivered it: no comments, no line breaks, nothing around the document.

    A family's documents have several roots; the first that a text holds is taken. A text without any stays as it is, so that it is
    rejected with what it says.
    """
    alike = [other for other in (*DOCUMENTS.values(), *ITEMS.values()) if other.family == kind.family]
    roots = [kind.root] if kind.is_event else list(dict.fromkeys(other.root for other in alike))
    return bronze.withColumn(xml, F.coalesce(clean_xml(xml, roots), xml))


def new_details(batch: DataFrame, kind: DocumentType, target: Target, refused: Observation | None = None) -> Filing:
    """Items of a batch that their table lacks by (chave, nItem), looked up in the months the batch belongs to."""
    details = item_filing(batch, kind, names_in_use(batch, kind), refused)
    folders = touched_folders(batch, target)
    return replace(details, rows=new_items(details.rows, read_table(batch.sparkSession, target.path, folders=folders))) if folders else details


def write_documents(batch: DataFrame, kind: DocumentType, target: Target, name: str | None = None) -> None:
    """File every document of a batch, or its items: in its table or, if it cannot be, with its text beside it.

    A batch with a ``name`` is filed once: signs beside the table tell a second run, or one after a failure, what is done. Items are filed
    once by their key as well, whatever batch brings them again.
    """
    refused = Observation()
    if kind.has_items:
        details = new_details(batch, kind, target, refused if name is not None else None)
        if name is None:
            write_partitioned(details.rows, target.path, columns=details.columns)
        else:
            computed = append_batch(details.rows, name, target.path, target.signs, columns=details.columns)
            append_batch(refusals(batch, kind, refused if computed else None), name, target.rejected, f"{target.signs}_rejected", ())
        return
    headers = accepted_filing(batch, kind, names_in_use(batch, kind), refused)
    if name is None:
        write_partitioned(headers.rows, target.path, columns=headers.columns)
        write_partitioned(refusals(batch, kind, refused), target.rejected, ())
    else:
        computed = append_batch(headers.rows, name, target.path, target.signs, columns=headers.columns)
        append_batch(refusals(batch, kind, refused if computed else None), name, target.rejected, f"{target.signs}_rejected", ())


def refusals(batch: DataFrame, kind: DocumentType, refused: Observation | None) -> DataFrame:
    """The rows of ``rejected``, which parses every document again, unless the write that ``refused`` observed has seen that there are none.

    A run that finds the documents written has observed nothing, and a plan that turned out to have no rows has no count.
    """
    others = rejected(batch, kind)
    try:
        none = refused is not None and refused.get.get("rows") == 0
    except Py4JError:
        none = False
    return others.filter(F.lit(False)) if none else others


def load(bronze: DataFrame, kind: DocumentType, target: Target, gate: Sequence[str] | None = (),
         where: str | None = None, name: str | None = None, clean: bool = False, keys: KeyTable | None = None) -> DataFrame:
    """Load one batch of one type and return the documents (or items) now in each partition it belongs to.

    ``gate``: columns that must be unique; None means whole rows, an empty list what the registry says for the type. ``name``: see
    ``write_documents``. ``clean``: the XML comes as the source has it, see ``cleaned``. ``keys``: the table that holds the keys of what is
    filed; it is brought up to what the months of the batch hold, so that keys a run didn't get to are filed by the next.
    """
    require_unique(bronze, kind.gate_columns if gate is not None and not gate else gate)
    batch = bronze.filter(where) if where else bronze
    batch = cleaned(batch, kind) if clean else batch
    write_documents(batch, kind, target, name)
    folders = touched_folders(batch, target)
    if not folders:  # all of it was rejected, or there was none
        return batch.sparkSession.createDataFrame([], f"{PARTITION} string, documents bigint")
    filed = read_table(batch.sparkSession, target.path, folders=folders)
    if keys is not None:
        add_keys(filed, keys)
    return count_by(filed, PARTITION, name="documents")


def touched_folders(batch: DataFrame, target: Target) -> list[str]:
    """Partition folders a batch belongs to, by the keys among its metadata: some months, out of many in the table.

    Documents without an answer have no key of their own and lie in the partition of NULL, whatever the metadata say.
    """
    months = batch.select(partition_key("CHAVE").alias(PARTITION)).distinct().collect()
    folders = [f"{PARTITION}={row[PARTITION]}" for row in months if row[PARTITION] is not None]
    folders.append(f"{PARTITION}=__HIVE_DEFAULT_PARTITION__")
    return [folder for folder in folders if exists(batch.sparkSession, f"{target.path}/{folder}")]


def load_with_items(bronze: DataFrame, header: DocumentType, detail: DocumentType, header_target: Target,
                    item_target: Target, gate: Sequence[str] = ("CHAVE",), name: str | None = None) -> None:
    """Load headers and items of one batch, which passes the gate once. With a ``name`` each of the three writes happens once, however
    often the batch is run.

    Without a name the documents are parsed once for all three, by their short layout, and stored beside the table until they are filed: few
    columns, and the text only of those that need it again.
    """
    require_unique(bronze, gate)
    names = names_in_use(bronze, header)
    if name is not None:
        write_documents(bronze, header, header_target, name)
        details = item_filing(bronze, detail, names)
        append_batch(details.rows, name, item_target.path, item_target.signs, columns=details.columns)
        return
    spark = bronze.sparkSession
    folder = f"{header_target.path}_read-{uuid.uuid4().hex[:12]}"
    try:
        read_once(bronze, header, detail, names).write.option("compression", "lz4").parquet(folder)
        parsed = spark.read.parquet(folder)
        for filing, target in ((accepted_filing(parsed, header, names), header_target), (item_filing(parsed, detail, names), item_target)):
            write_partitioned(filing.rows, target.path, columns=filing.columns)
        write_partitioned(rejected(parsed, header), header_target.rejected, ())
    finally:
        remove(spark, folder)
