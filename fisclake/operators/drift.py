"""Fields that documents have and the layouts do not, and the other way round."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fisclake.layouts.tree import CORRUPT, leaf_paths
from fisclake.operators.parse import route
from fisclake.registry import ITEMS, XML, DocumentType

# Fixed value: the digital signature is no part of the layouts.
IGNORED = "signature"


# An array in a shape is an object with this one key.
ELEMENT = "[]"


def as_json(schema: Column) -> Column:
    """The text of a variant's schema as JSON, an array as an object with one key. Its type names were replaced before (``LEAF``)."""
    arrays = F.regexp_replace(schema, "ARRAY<", f"OBJECT<{ELEMENT}: ")
    quoted = F.regexp_replace(arrays, "`([^`]+)`: ", '"$1": ')  # names with a prefix
    names = F.regexp_replace(quoted, r"(<|, )([^`\":<>, ]+): ", '$1"$2": ')
    return F.translate(F.replace(names, F.lit("OBJECT<"), F.lit("{")), ">", "}")


# A type name in a schema text, where it is not the start of an object or array. VARIANT stands where values of different kinds meet.
LEAF = r"(^|: |<)(?!OBJECT<|ARRAY<)[A-Z_]+(?:\(\d+,\d+\))?(?=[,>]|$)"


def _shape(node: Column) -> Column:
    """Structure of one document as JSON, without its values: documents of the same structure become equal.

    Values of different kinds in the elements of one array hide its structure. Then all values are made texts, which leaves only elements
    that differ in structure; where there are such, the document is kept with each of its values replaced by null.
    """

    def structure(schema: Column) -> Column:
        return as_json(F.regexp_replace(schema, LEAF, "$1null"))

    def valueless(value: str) -> Column:
        texts = F.regexp_replace(F.to_json(node), r'(?<=[:\[,])"(?:[^"\\]|\\.)*+"(?=[,\]}])', value)
        return F.regexp_replace(texts, r"(?<=[:\[,])(?:-?[0-9][0-9.eE+-]*+|true|false)(?=[,\]}])", value)

    schema = F.schema_of_variant(node)
    alike = F.schema_of_variant(F.parse_json(valueless('""')))
    return (
        F.when(~schema.contains("VARIANT"), structure(schema))
        .when(~alike.contains("VARIANT"), structure(alike))
        .otherwise(valueless("null"))
    )


# What XML has no place for: a value with any of it is left as it is, like one with markup or references. Classes list their characters: Java
# looks these up in one table, but tries ranges one after another.
_ODD = "".join(rf"\x{code:02X}" for code in range(32) if code not in (9, 10, 13))
_SIGN = "[" + "".join(rf"\x{code:02X}" for code in range(33, 127) if chr(code) not in "<>&\"'") + "]"
_CDATA = rf"<!\[CDATA\[{{first}}(?:[^\]{_ODD}]++|\](?!\]>))*+\]\]>"
_NONCHARACTERS = ("\uFFFE", "\uFFFF")
_LONG = 4096
_NAMED, _NUMBERED = "&(?:amp|lt|gt|quot|apos);", "&#(?:3[3-9]|[4-9][0-9]|1[01][0-9]);"
# A number beyond doubt, and a text beyond doubt: it begins with a letter, holds a sign no number has, or has more digits than a decimal.
_SURE_NUMBER = r"-?(?:[0-9]{1,18}+(?:\.[0-9]{1,18}+)?|[0-9]{19,38}+)"
_SURE_TEXT = r"(?:[A-Za-z]|[0-9+.,-]++[/:_A-DF-Za-df-z]|[0-9.,]++-)REST|[1-9][0-9]{38,}+"
_LEAF_ELEMENT = r"(<[A-Za-z_][^<>]*+(?<!/)>)"
_ATTRIBUTE = r"(\s(?!xml|xsi|version|encoding|standalone)[A-Za-z_][\w:.-]*+=)"
_REPEATED = r"(<([A-Za-z_][\w:.-]*+)(?:\s[^<>]*+)?(?<!/)>(?:[^<]++|<(?!/?\2[\s/>]))*+</\2>)\1+"


def skeleton(xml: Column, typed: bool = False) -> Column:
    """The text of a document with a letter in place of each value (``typed``: a digit where it is a number) and, if it is long,
    at most two of like neighbours.

    Parsed, it has the structure of the document, and most documents of one structure have the same skeleton, so that these can be merged
    before anything is parsed. Values that aren't plain stay as they are; their documents are only less alike.
    """

    def marked(text: Column, value: str, mark: str) -> Column:
        content, quoted = (value.replace("REST", f"[^<>&{quotes}{_ODD}]*+") for quotes in ("", "\"'"))
        inside = F.regexp_replace(text, f"{_LEAF_ELEMENT}(?:{content})(?=</)", f"$1{mark}")
        return F.regexp_replace(inside, f"{_ATTRIBUTE}(?:\"(?:{quoted})\"|'(?:{quoted})')", f'$1"{mark}"')

    def where(text: Column, sign: str, pattern: str, value: str) -> Column:
        return F.when(text.contains(sign), F.regexp_replace(text, pattern, value)).otherwise(text)

    if typed:
        plain = where(xml, "&", _NAMED, "x")
        plain = where(plain, "<![", f"{_LEAF_ELEMENT}{_CDATA.replace('{first}', '[A-Za-z]')}(?=</)", "$1x")
        text = marked(marked(plain, _SURE_NUMBER, "1"), _SURE_TEXT, "x")
    else:
        plain = where(xml, "&", f"{_NAMED}|{_NUMBERED}", "x")
        plain = where(plain, "<![", _CDATA.replace("{first}", r"\s*+[^\x00-\x20\]\x7F-\x{10FFFF}]"), "x")
        text = marked(plain, rf"\s*+{_SIGN}REST", "x")
    odd = xml.contains(_NONCHARACTERS[0]) | xml.contains(_NONCHARACTERS[1])
    return F.when(odd, xml).when(F.octet_length(xml) > _LONG, F.regexp_replace(text, _REPEATED, "$1$1")).otherwise(text)


def parsed_skeletons(skeletons: DataFrame, *kept: str) -> DataFrame:
    """Column ``text`` of distinct skeletons parsed, as ``parsed.document``; texts that are no XML have no row."""
    parsed = F.expr("from_xml(text, 'document variant', map('singleVariantColumn', 'document'))")
    return skeletons.select(*kept, F.explode(F.array(parsed)).alias("parsed")).filter("parsed.document IS NOT NULL")


def _descend(nodes: DataFrame) -> DataFrame:
    """One level down: children of objects under ``path.key``, elements of arrays under ``path[]``, leaves as they are."""
    children = nodes.sparkSession.tvf.variant_explode_outer(F.col("node").outer())
    element = (F.col("key") == ELEMENT) | (F.col("key").isNull() & F.col("value").isNotNull())
    path = (
        F.when(element, F.concat("path", F.lit(ELEMENT)))
        .when(F.col("key").isNull(), F.col("path"))
        .otherwise(F.concat_ws(".", F.nullif("path", F.lit("")), "key"))
    )
    kept = [name for name in nodes.columns if name not in ("path", "node")]
    return nodes.lateralJoin(children).select(*kept, path.alias("path"), F.col("value").alias("node"))


def element_paths(df: DataFrame, xml: str = XML) -> list[str]:
    """Distinct paths of all leaves in all documents, ``[]`` after repeated elements.

    Every document is reduced to its skeleton, equal ones are merged before the shuffle, and only what is left is parsed and
    unfolded, level by level. What reaches the driver grows with the number of different tags, not with the data. A sample
    would miss the rare tags this is for, and staging the text for the XML source would write all of it again.
    """
    return sorted(path for _, path in _labelled_paths(df.select(F.lit("").alias("label"), xml), xml))


def _labelled_paths(df: DataFrame, xml: str = XML) -> set[tuple[str, str]]:
    """The same for each ``label`` of documents, in one pass."""
    skeletons = df.select("label", skeleton(F.col(xml)).alias("text")).distinct()
    shapes = parsed_skeletons(skeletons, "label").select("label", _shape(F.col("parsed.document")).alias("shape")).distinct()
    depth = 14
    while True:
        nodes = shapes.select("label", F.lit("").alias("path"), F.parse_json("shape").alias("node"))
        for _ in range(depth):
            nodes = _descend(nodes)
        found = nodes.select("label", "path", F.col("node").isNotNull().alias("deeper")).distinct().collect()
        if not any(row.deeper for row in found):
            return {(row.label, row.path) for row in found if row.path}
        depth *= 2


def merge_paths(paths: Iterable[str]) -> T.StructType:
    """The schema that holds all ``paths``: an element repeated anywhere is an array, every leaf is text."""
    children: dict[str, list[str]] = {}
    repeated = set()
    for path in paths:
        head, _, rest = path.partition(".")
        name = head.removesuffix("[]")
        if head != name:
            repeated.add(name)
        children.setdefault(name, []).append(rest)
    fields = []
    for name, rests in children.items():
        below = [rest for rest in rests if rest]
        kind = merge_paths(below) if below else T.StringType()
        fields.append(T.StructField(name, T.ArrayType(kind) if name in repeated else kind))
    return T.StructType(fields)


def infer_schema(df: DataFrame, xml: str = XML) -> T.StructType:
    """Schema of all documents in a column together, every leaf as text: a 44-digit key is no number."""
    return merge_paths(element_paths(df, xml))


def official_paths(kind: DocumentType) -> set[str]:
    return {path for path in leaf_paths(kind.layout.parse_schema()) if path != CORRUPT}


def observed_paths(bronze: DataFrame, kind: DocumentType) -> set[str]:
    return {path.replace("[]", "") for path in element_paths(route(bronze, kind))}


def unknown_paths(observed: Iterable[str], official: Iterable[str]) -> list[str]:
    """Observed but not official, without the signature."""
    official = {path.lower() for path in official}
    return sorted(p for p in observed if p.lower() not in official and IGNORED not in p.lower())


def unused_paths(observed: Iterable[str], official: Iterable[str]) -> list[str]:
    """Official but never observed."""
    observed = {path.lower() for path in observed}
    return sorted(p for p in official if p.lower() not in observed)


def drift(spark: SparkSession, bronze: DataFrame, kind: DocumentType) -> DataFrame:
    """One row per field that the layout lacks."""
    rows = [(kind.name, path) for path in unknown_paths(observed_paths(bronze, kind), official_paths(kind))]
    return spark.createDataFrame(rows, "document string, path string")


def unused(spark: SparkSession, bronze: DataFrame, kind: DocumentType) -> DataFrame:
    """One row per field of the layout that no document has."""
    rows = [(kind.name, path) for path in unused_paths(observed_paths(bronze, kind), official_paths(kind))]
    return spark.createDataFrame(rows, "document string, path string")


def own_paths(paths: Iterable[str], kind: DocumentType) -> set[str]:
    """The paths a type answers for where a family has headers and items: items those with ``det``, headers the others."""
    if kind.family not in {item.family for item in ITEMS.values()} or kind.is_event:
        return set(paths)
    return {path for path in paths if ("det" in path.split(".")) == (kind in ITEMS.values())}


def report(spark: SparkSession, batches: Iterable[tuple[DocumentType, DataFrame]]) -> DataFrame:
    """One row per document type: fields seen, fields in the layout, unknown fields, and whether the layout is complete.

    Headers and items of one family each count their own fields only.
    """
    pairs = list(batches)
    shared: list[tuple[DataFrame, list[int]]] = []  # batches that are the same rows are read once
    for n, (_, bronze) in enumerate(pairs):
        alike = next((numbers for other, numbers in shared if other.sameSemantics(bronze)), None)
        if alike is None:
            shared.append((bronze, [n]))
        else:
            alike.append(n)
    seen: list[set[str]] = [set() for _ in pairs]
    for bronze, numbers in shared:
        label = F.concat_ws(",", *(F.when(F.expr(pairs[n][0].route or "true"), str(n)) for n in numbers)).alias("label")
        for label, path in _labelled_paths(bronze.select(label, XML).filter("label <> ''")):
            for n in label.split(","):
                seen[int(n)].add(path.replace("[]", ""))
    rows = []
    for (kind, _), paths in zip(pairs, seen, strict=True):
        observed, official = own_paths(paths, kind), own_paths(official_paths(kind), kind)
        unknown = unknown_paths(observed, official)
        rows.append((kind.name, len(observed), len(official), len(unknown), not unknown))
    schema = "document string, observed bigint, official bigint, unknown bigint, complete boolean"
    return spark.createDataFrame(rows, schema)


def layout_paths(spark: SparkSession, kind: DocumentType) -> DataFrame:
    """Leaf paths of a layout."""
    return spark.createDataFrame([(kind.name, path) for path in sorted(official_paths(kind))], "document string, path string")


def ddl(schema: T.StructType) -> str:
    """A schema as DDL text, to be stored and read back with ``StructType.fromDDL``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
