"""All document types as data: a new type is an entry here, not new code."""

from __future__ import annotations

from dataclasses import dataclass

from fisclake.layouts import events, freight, goods, passage, utilities
from fisclake.layouts.tree import Layout

XML = "XML_DOCUMENTO_CLOB"
HEADER_METADATA = ("DHEMI", "IP_TRANSMISSOR")
FREIGHT_METADATA = (*HEADER_METADATA, "MODELO", "TPEMIS")
ITEM_METADATA = ("IP_TRANSMISSOR", "EMITENTE", "DESTINATARIO", "UF_EMITENTE", "UF_DESTINATARIO", "DHEMI")
EVENT_METADATA = ("DHEVENTO", "IP_TRANSMISSOR")

# A sequence number below this was given by the old source, from it on by the new one.
SOURCE_SWITCH = 1_000_000_000


@dataclass(frozen=True)
class DocumentType:
    """One kind of document and how to find and read it.

    ``route`` is a SQL predicate over the bronze columns that picks this type out of its family's rows. ``gate`` says what must be unique in a
    batch: its sequence numbers, its access keys (``key``) or whole rows (``row``).
    """

    name: str
    family: str
    sequence: str
    root: str
    layout: Layout
    route: str | None = None
    metadata: tuple[str, ...] = HEADER_METADATA
    group: str = ""
    gate: str = "sequence"

    @property
    def gate_columns(self) -> list[str] | None:
        """Columns that must be unique together in a batch; None means whole rows."""
        return {"sequence": [self.sequence], "key": ["CHAVE"], "row": None}[self.gate]

    @property
    def has_items(self) -> bool:
        """Whether this type is the line items of its documents."""
        return self.layout.item is not None

    @property
    def bronze(self) -> str:
        """Folder of the source rows: documents lie under their family, events and cancellations beside it."""
        return f"{self.family}_{self.group}" if self.group in ("evento", "cancelamento") else self.family

    @property
    def silver(self) -> str:
        """Folder of the table."""
        return f"{self.family}/{self.group or self.name}"

    @property
    def is_event(self) -> bool:
        return self.metadata == EVENT_METADATA

    @property
    def audit_keys(self) -> tuple[str, str]:
        """Columns by which bronze and silver are compared; an event need not have an access key."""
        return (self.sequence, self.sequence) if self.is_event else ("CHAVE", "chave")


def _tagged(tag: str) -> str:
    return rf"{XML} IS NOT NULL AND {XML} RLIKE '<{tag}[\\s>]'"


def _freight(name: str, root: str, layout: Layout, route: str) -> DocumentType:
    return DocumentType(name, "cte", "NSUSVD", root, layout, route, FREIGHT_METADATA)


DOCUMENTS = {
    entry.name: entry
    for entry in (
        DocumentType("NFe", "nfe", "NSUDF", "nfeProc", goods.NFE, group="infNFe", gate="key"),
        DocumentType("NFCe", "nfce", "NSU", "nfeProc", goods.NFCE, group="infNFCe", gate="key"),
        _freight("CTe", "cteProc", freight.CTE, f"MODELO = 57 AND {XML} RLIKE '<cteProc'"),
        _freight("CTeSimp", "cteSimpProc", freight.CTE_SIMPLIFIED, f"MODELO = 57 AND {XML} RLIKE '<cteSimpProc'"),
        _freight("CTeOS", "cteOSProc", freight.CTE_OS, "MODELO = 67"),
        _freight("GVTe", "GTVeProc", freight.GTVE, "MODELO = 64"),
        DocumentType("MDFe", "mdfe", "NSU", "mdfeProc", freight.MDFE),
        DocumentType("BPe", "bpe", "NSU", "bpeProc", passage.BPE, _tagged("BPe")),
        DocumentType("BPeTA", "bpe", "NSU", "bpeProc", passage.BPE_AIR, _tagged("BPeTA")),
        DocumentType("NF3e", "nf3e", "NSU", "nf3eProc", utilities.NF3E),
        DocumentType("NFCom", "nfcom", "NSU", "NFComProc", utilities.NFCOM),
    )
}

ITEMS = {
    "NFe": DocumentType("NFeDet", "nfe", "NSUDF", "nfeProc", goods.ITEMS, metadata=ITEM_METADATA, group="det", gate="key"),
    "NFCe": DocumentType("NFCeDet", "nfce", "NSU", "nfeProc", goods.ITEMS, metadata=ITEM_METADATA, group="det", gate="key"),
}


# Layout and reply of events and cancellations per family (fixed values: sequence column and root element).
_EVENT_FAMILIES = {
    "NFe": ("nfe", "NSUDF", "procEventoNFe", events.NFE),
    "NFCe": ("nfce", "NSU", "procEventoNFe", events.NFCE),
    "CTe": ("cte", "NSUSVD", "procEventoCTe", events.CTE),
    "MDFe": ("mdfe", "NSU", "procEventoMDFe", events.MDFE),
    "BPe": ("bpe", "NSU", "procEventoBPe", events.BPE),
    "NF3e": ("nf3e", "NSU", "procEventoNF3e", events.NF3E),
    "NFCom": ("nfcom", "NSU", "procEventoNFCom", events.NFCOM),
}


def _events(group: str, names: tuple[str, ...], gate: str) -> dict[str, DocumentType]:
    return {
        name: DocumentType(name, *_EVENT_FAMILIES[name], metadata=EVENT_METADATA, group=group, gate=gate) for name in names
    }


CANCELLATIONS = _events("cancelamento", tuple(_EVENT_FAMILIES), gate="row")
# NFC-e has cancellations but no other events.
EVENTS = _events("evento", tuple(name for name in _EVENT_FAMILIES if name != "NFCe"), gate="sequence")

# What the full audit compares: every kind of document, cancellation and event.
AUDITED = (*DOCUMENTS.values(), *CANCELLATIONS.values(), *EVENTS.values())
