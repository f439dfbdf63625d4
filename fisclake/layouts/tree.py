"""Document layouts as small trees of XML groups.

A layout states only which groups and leaves a document has. Everything else follows by rule:

* the parse schema: every leaf is read as STRING, repeated groups as arrays;
* the output columns: ``<group>_<leaf>``, the group being the innermost one (``dest/enderDest/CEP`` is
  ``enderDest_CEP``); the exceptions are written next to the group they belong to;
* the types: leaves whose name marks an amount, quantity or rate become DOUBLE, all others stay STRING.

Spark resolves column names without regard to case, so the names keep the case of the XML.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# How the national layouts name amounts, quantities, rates and weights ...
AMOUNT = re.compile(r"^(v|q|p|adRem)[A-Z]|^qtd[PRST]|^peso")
# ... the other numeric leaves ...
NUMERIC_LEAVES = frozenset({"cListServ", "dExpiracao", "enerAloc", "nCompra", "nPeso"})
# ... and the leaves that look numeric but are text.
TEXT_LEAVES = frozenset(
    {"qSelo", "qVol", "qTotEmb", "qCT", "qCTe", "qMDFe", "qNF", "qNFe", "qTotProd", "qVag", "qVolTipo", "vValePed"}
)
TEXT_GROUPS = frozenset({"veicProd"})


def is_numeric(group: str, leaf: str) -> bool:
    if leaf in TEXT_LEAVES or group in TEXT_GROUPS:
        return False
    return leaf in NUMERIC_LEAVES or AMOUNT.match(leaf) is not None


@dataclass(frozen=True)
class OutputColumn:
    """One column of a silver table: where it is read and what it becomes."""

    name: str
    path: tuple[str, ...]
    type: T.DataType


@dataclass(frozen=True)
class Group:
    """One XML element with children. ``leaves`` ending in ``[]`` are repeated plain elements."""

    name: str
    leaves: tuple[str, ...] = ()
    children: tuple[Group, ...] = ()
    repeated: bool = False
    prefix: str | None = None
    names: dict[str, str] = field(default_factory=dict)
    column: str | None = None
    opaque: bool = False
    #: Leaves whose type the rule by name doesn't give: "string", "double" or "bigint".
    types: dict[str, str] = field(default_factory=dict)
    #: A repeated group kept as the array of its only leaf.
    flat: bool = False

    @property
    def column_prefix(self) -> str:
        return self.name if self.prefix is None else self.prefix

    def struct(self, typed: bool = False) -> T.StructType:
        """The Spark type of this group: all leaves STRING, or (``typed``) as in the silver table."""
        fields = []
        for leaf in self.leaves:
            name = leaf.removesuffix("[]")
            leaf_type = self.leaf_type(name) if typed else T.StringType()
            fields.append(T.StructField(name, T.ArrayType(leaf_type) if leaf.endswith("[]") else leaf_type))
        fields += [T.StructField(child.name, child.data_type(typed)) for child in self.children]
        return T.StructType(fields)

    def leaf_type(self, leaf: str) -> T.DataType:
        if leaf in self.types:
            return {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}[self.types[leaf]]
        return T.DoubleType() if is_numeric(self.name, leaf) else T.StringType()

    def data_type(self, typed: bool = False) -> T.DataType:
        return T.ArrayType(self.struct(typed)) if self.repeated else self.struct(typed)

    def columns(self, path: tuple[str, ...] = (), parent: str = "") -> Iterator[OutputColumn]:
        """Output columns below ``path``, depth first; a repeated or opaque group is one column."""
        if self.flat:
            (leaf,) = self.leaves
            yield OutputColumn(f"{self.name}_{leaf}", (*path, leaf), T.ArrayType(self.leaf_type(leaf)))
            return
        if self.repeated or self.opaque or self.column is not None:
            default = f"{parent}_{self.name}" if parent else self.name
            yield OutputColumn(self.column or default, path, self.data_type(typed=True))
            if self.repeated or self.opaque:
                return
        prefix = self.column_prefix
        typed = self.struct(typed=True)
        for leaf in self.leaves:
            leaf = leaf.removesuffix("[]")
            default = "_".join(part for part in (prefix, leaf.lstrip("_")) if part)
            yield OutputColumn(self.names.get(leaf, default), (*path, leaf), typed[leaf].dataType)
        for child in self.children:
            yield from child.columns((*path, child.name), prefix)

    def pruned(self, paths: Collection[tuple[str, ...]], at: tuple[str, ...] = ()) -> Group | None:
        """The part of this group needed to read ``paths`` (a path keeps everything below it)."""
        if at in paths:
            return self
        leaves = tuple(leaf for leaf in self.leaves if (*at, leaf.removesuffix("[]")) in paths)
        kept = (child.pruned(paths, (*at, child.name)) for child in self.children)
        children = tuple(child for child in kept if child is not None)
        return replace(self, leaves=leaves, children=children) if leaves or children else None


@dataclass(frozen=True)
class Layout:
    """A whole document (``exploded`` is None) or its line items (``exploded`` is the path of the items)."""

    root: Group
    exploded: tuple[str, ...] | None = None
    item: Group | None = None

    def columns(self) -> list[OutputColumn]:
        return list(self.root.columns())

    def item_columns(self) -> list[OutputColumn]:
        return list(replace(self.item, repeated=False).columns()) if self.item else []

    def select(self, names: Collection[str]) -> Layout:
        """The same layout cut down to the named output columns, so that the parser skips the rest."""
        wanted = {name.lower() for name in names}
        root = self.root.pruned({c.path for c in self.columns() if c.name.lower() in wanted})
        item = self.item
        if item is not None:
            item = item.pruned({c.path for c in self.item_columns() if c.name.lower() in wanted})
            item = item or replace(self.item, children=(), leaves=self.item.leaves[:1])
        return replace(self, root=root or replace(self.root, children=(), leaves=()), item=item)

    def parse_schema(self) -> T.StructType:
        """All-string schema for ``from_xml``, with a column that catches malformed documents."""
        return T.StructType([*self.whole().struct().fields, T.StructField(CORRUPT, T.StringType())])

    def whole(self) -> Group:
        """The root with the items in their place."""
        return self.root if self.item is None else _with_group(self.root, self.exploded, self.item)


def _with_group(root: Group, path: tuple[str, ...], leaf: Group) -> Group:
    if not path:
        return replace(root, children=(*root.children, leaf))
    children = list(root.children)
    for i, child in enumerate(children):
        if child.name == path[0]:
            children[i] = _with_group(child, path[1:], leaf)
            break
    else:
        children.append(_with_group(Group(path[0]), path[1:], leaf))
    return replace(root, children=tuple(children))


def group(name: str, leaves: str = "", *children: Group, prefix: str | None = None,
          names: dict[str, str] | None = None, column: str | None = None, types: dict[str, str] | None = None) -> Group:
    """An element that occurs at most once; ``column`` also keeps it whole under that name."""
    return Group(name, tuple(leaves.split()), children, prefix=prefix, names=names or {}, column=column, types=types or {})


def many(name: str, leaves: str = "", *children: Group, column: str | None = None, flat: bool = False) -> Group:
    """A repeated element, kept as one array column."""
    return Group(name, tuple(leaves.split()), children, repeated=True, column=column, flat=flat)


def whole(name: str, leaves: str) -> Group:
    """An element kept as one struct column."""
    return Group(name, tuple(leaves.split()), opaque=True)


def document(*children: Group, leaves: str = "", names: dict[str, str] | None = None) -> Layout:
    return Layout(group("", leaves, *children, prefix="", names=names))


def leaf_paths(data_type: T.DataType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves; arrays of structs are descended, other arrays are leaves."""
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        data_type = data_type.elementType
    if not isinstance(data_type, T.StructType):
        return [prefix]
    return [
        path
        for f in data_type.fields
        for path in leaf_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    ]
