"""From the XML string to silver rows: route, parse once, project, explode."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, replace
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fisclake.functions.dates import formatted_hour
from fisclake.functions.keys import PARTITION, with_partition_key
from fisclake.layouts.tree import CORRUPT, Layout, OutputColumn
from fisclake.registry import XML, DocumentType


def route(bronze: DataFrame, kind: DocumentType) -> DataFrame:
    """Rows of ``bronze`` that are documents of this kind."""
    return bronze.filter(kind.route) if kind.route else bronze


def unrouted(bronze: DataFrame, kinds: Iterable[DocumentType]) -> DataFrame:
    """Rows of a family that none of its kinds takes, which would otherwise go unnoticed."""
    taken = " OR ".join(f"coalesce({kind.route or 'true'}, false)" for kind in kinds)
    return bronze.filter(f"NOT ({taken})")


def select_bronze(bronze: DataFrame, kind: DocumentType) -> DataFrame:
    """The metadata a silver table keeps, the sequence number as STRING, and the XML as ``xml``."""
    text = (kind.sequence, "MODELO", "TPEMIS")
    return bronze.select(
        F.col(XML).cast("string").alias("xml"),
        formatted_hour("DHPROC").alias("DHPROC_FORMATADO"),
        *(
            F.col(name).cast("string").alias(name) if name in text else F.col(name)
            for name in (kind.sequence, *kind.metadata)
        ),
    )


def parse(df: DataFrame, layout: Layout, xml: str = "xml", into: str = "parsed") -> DataFrame:
    """Replace the XML by its struct.

    The parser runs inside a generator: Spark does not move predicates below one. As a plain column, every later
    filter on a parsed field, and the size test that ``explode`` implies, would parse the text a second time.
    """
    struct = F.from_xml(xml, layout.parse_schema(), {"columnNameOfCorruptRecord": CORRUPT})
    kept = [name for name in df.columns if name != xml]
    return df.select(*kept, F.explode(F.array(struct)).alias(into))


def _expression(column: OutputColumn, root: str) -> str:
    path = ".".join(f"`{name}`" for name in (root, *column.path))
    spark_type = column.type.simpleString()
    value = f"try_cast({path} AS {spark_type})" if "double" in spark_type or "bigint" in spark_type else path
    return f"{value} AS `{column.name}`"


def project(parsed: DataFrame, columns: Iterable[OutputColumn], *others: str, root: str = "parsed") -> DataFrame:
    """Flatten the struct; numbers that are not numbers become NULL without harming the rest of the row.

    ``others`` are SQL expressions to keep beside it. One SQL string per column: layouts have hundreds.
    """
    return parsed.selectExpr(*others, *(_expression(column, root) for column in columns))


def header_rows(parsed: DataFrame, kind: DocumentType, layout: Layout | None = None) -> DataFrame:
    """One wide row per document."""
    kept = (kind.sequence, "DHPROC_FORMATADO", *kind.metadata)
    return with_partition_key(project(parsed, (layout or kind.layout).columns(), *kept))


def item_rows(parsed: DataFrame, kind: DocumentType, layout: Layout | None = None) -> DataFrame:
    """One row per line item; a document without items has none."""
    layout = layout or kind.layout
    kept = (kind.sequence, "DHPROC_FORMATADO", *kind.metadata)
    items_at = ".".join(("parsed", *layout.exploded, layout.item.name))
    exploded = project(parsed, layout.columns(), *kept, f"explode({items_at}) AS item")
    names = [name for name in exploded.columns if name != "item"]
    return with_partition_key(project(exploded, layout.item_columns(), *names, root="item"))


def _parsed(bronze: DataFrame, kind: DocumentType, columns: Iterable[str] | None) -> tuple[DataFrame, Layout]:
    layout = kind.layout.select({*columns, "chave"}) if columns is not None else kind.layout
    return parse(select_bronze(route(bronze, kind), kind), layout), layout


def documents(bronze: DataFrame, kind: DocumentType, columns: Iterable[str] | None = None) -> DataFrame:
    """Silver header, event or cancellation rows; ``columns`` parses only what those need."""
    parsed, layout = _parsed(bronze, kind, columns)
    return header_rows(parsed, kind, layout)


def items(bronze: DataFrame, kind: DocumentType, columns: Iterable[str] | None = None) -> DataFrame:
    """Silver item rows."""
    parsed, layout = _parsed(bronze, kind, columns)
    return item_rows(parsed, kind, layout)


WELL_FORMED = f"parsed IS NOT NULL AND parsed.{CORRUPT} IS NULL"


def accepted(bronze: DataFrame, kind: DocumentType, columns: Iterable[str] | None = None) -> DataFrame:
    """The rows of :func:`documents` that can be filed: well-formed and, unless an event that was not answered yet, with key."""
    parsed, layout = _parsed(bronze, kind, columns)
    rows = header_rows(parsed.filter(WELL_FORMED), kind, layout)
    return rows if kind.is_event else rows.filter("chave IS NOT NULL")


def rejected(bronze: DataFrame, kind: DocumentType) -> DataFrame:
    """The others, with the reason and their text: together with :func:`accepted` every row once. ``bronze`` may be the rows of :func:`read_once`."""
    layout = kind.layout.select({"chave"})
    well_formed = f"({WELL_FORMED}) AS well_formed"
    if "parsed" in bronze.columns:  # read_once
        parsed = bronze.withColumnRenamed("xml", XML)
    else:
        parsed = parse(select_bronze(route(bronze, kind), kind).withColumn(XML, F.col("xml")), layout)
    rows = project(parsed, layout.columns(), kind.sequence, "DHPROC_FORMATADO", XML, well_formed)
    reason = F.when(~F.col("well_formed"), "malformed").when(F.col("chave").isNull() & F.lit(not kind.is_event), "no key")
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").select(
        kind.sequence, "DHPROC_FORMATADO", "reason", XML
    )


# Documents whose element names are looked at before a load, and the share of them that must hold a name for the short layout to have it.
NAMES_FROM, NAMES_SHARE = 1_000, 0.01


@dataclass(frozen=True)
class Filing:
    """Rows on their way into a table: ``rows`` has the columns that most rows fill and, as one struct, what few do; the SQL expressions
    ``columns`` make the table's columns of them, once the rows are where they are written."""

    rows: DataFrame
    columns: Sequence[str] = ("*",)


def names_in_use(bronze: DataFrame, kind: DocumentType) -> list[str]:
    """The element names that the first documents have in common. They decide how a document is read, not what is read of it."""
    texts = route(bronze, kind).select(F.col(XML).cast("string").alias("xml")).limit(NAMES_FROM)
    found = F.array_distinct(F.regexp_extract_all("xml", F.lit(r"<([A-Za-z_][A-Za-z0-9_.:-]*)(?=[\s/>])"), F.lit(1)))
    counted = texts.select(F.explode(F.array_append(found, "")).alias("name")).groupBy("name").count()  # every text has the empty one
    counts = {row.name: row["count"] for row in counted.collect()}
    return sorted(name for name, count in counts.items() if name and count >= NAMES_SHARE * counts[""])


def _filled(columns: Iterable[OutputColumn], names: Collection[str]) -> set[str]:
    """Columns that a document with these element names can fill; attributes go with their element."""
    known = {name.lower() for name in names}
    return {c.name for c in columns if all(part.startswith("_") or part.lower() in known for part in c.path)}


def _other(names: Sequence[str]) -> Column:
    """Whether a text holds an element, or other markup, of a name that is not among these; names are tried by their first letter."""
    alike = (f"{first}(?:{'|'.join(re.escape(name[1:]) for name in group)})" for first, group in groupby(sorted(names), lambda name: name[0]))
    return F.col("xml").rlike(rf"<(?!/|\?xml |(?:{'|'.join(alike)})[\s/>])")


def _from_xml(layout: Layout) -> Column:
    return F.from_xml("xml", layout.parse_schema(), {"columnNameOfCorruptRecord": CORRUPT})


def _parsed_twice(bronze: DataFrame, kind: DocumentType, short: Layout, long: Layout | None, names: Sequence[str]) -> DataFrame:
    """``parsed`` by the short layout, and ``rest``: what only the long one has, NULL unless the text holds an element of another name.

    The parser looks at every field of every group it meets, so a group of a hundred fields costs as much with two of them filled as with all.
    ``bronze`` may be the rows of :func:`read_once`, which are parsed by the short layout already.
    """
    if "parsed" in bronze.columns:
        kept = (kind.sequence, "DHPROC_FORMATADO", *kind.metadata, "parsed")
        structs = [F.when(F.col("other"), _from_xml(long)).alias("rest")] if long is not None else []
        return bronze.select(*kept, *(F.inline(F.array(F.struct(*structs))) for _ in structs))
    df = select_bronze(route(bronze, kind), kind)
    structs = [_from_xml(short).alias("parsed")]
    if long is not None:
        structs.append(F.when(_other(names), _from_xml(long)).alias("rest"))
    return df.select(*(name for name in df.columns if name != "xml"), F.inline(F.array(F.struct(*structs))))


def _short(kind: DocumentType, names: Sequence[str]) -> set[str]:
    """Columns of the short layout: a document's, or its items' (the few of their document are all in it)."""
    layout = kind.layout
    if layout.item is None:
        return _filled(layout.columns(), names) | {"chave"}
    inside = [replace(c, path=(*layout.exploded, layout.item.name, *c.path)) for c in layout.item_columns()]
    return {c.name for c in layout.columns()} | _filled(inside, names) | {"nItem"}


def read_once(bronze: DataFrame, header: DocumentType, detail: DocumentType, names: Sequence[str]) -> DataFrame:
    """Documents parsed by the short layout of a type and of its items at once, to be stored and filed from there; the text is kept of those that
    hold other names or can't be filed."""
    items_short = detail.layout.select(_short(detail, names))
    chosen = {c.path for c in header.layout.columns() if c.name in _short(header, names)} | {c.path for c in items_short.columns()}
    short = Layout(header.layout.root.pruned(chosen), items_short.exploded, items_short.item)
    both = replace(header, metadata=tuple(dict.fromkeys((*header.metadata, *detail.metadata))))
    df = select_bronze(route(bronze, header), both).withColumn("other", F.coalesce(_other(names), F.lit(False)))
    parsed = df.select("*", F.inline(F.array(F.struct(_from_xml(short).alias("parsed")))))
    kept = F.expr(f"CASE WHEN other OR NOT ({WELL_FORMED} AND {_key(header)} IS NOT NULL) THEN xml END")
    return parsed.withColumn("xml", kept)


def _key(kind: DocumentType) -> str:
    return ".".join(("parsed", *next(c.path for c in kind.layout.columns() if c.name == "chave")))


def _whole(kept: Sequence[str], columns: Iterable[OutputColumn], short: set[str]) -> list[str]:
    """Expressions for the table's columns, in the table's order."""
    return [*kept, *(f"`{c.name}`" if c.name in short else _expression(c, "rest") for c in columns), PARTITION]


def accepted_filing(bronze: DataFrame, kind: DocumentType, names: Sequence[str], refused: Observation | None = None) -> Filing:
    """The rows of :func:`accepted`; ``refused`` is told how many rows are not among them, as ``rows``."""
    columns = kind.layout.columns()
    filled = _short(kind, names)
    others = [c.name for c in columns if c.name not in filled]
    short, long = kind.layout.select(filled), kind.layout.select(others) if others else None
    parsed = _parsed_twice(bronze, kind, short, long, names)
    good = WELL_FORMED + (f" AND (rest IS NULL OR rest.{CORRUPT} IS NULL)" if others else "")
    good += "" if kind.is_event else f" AND {_key(kind)} IS NOT NULL"
    if refused is not None:
        parsed = parsed.observe(refused, F.expr(f"count_if(NOT ({good}))").alias("rows"))
    kept = (kind.sequence, "DHPROC_FORMATADO", *kind.metadata)
    rows = project(parsed.filter(good), [c for c in columns if c.name in filled], *kept, *(["rest"] if others else []))
    return Filing(with_partition_key(rows), _whole(kept, columns, filled))


def item_filing(bronze: DataFrame, kind: DocumentType, names: Sequence[str], refused: Observation | None = None) -> Filing:
    """The rows of :func:`items` that have a key; ``refused`` is told, as ``rows``, how many documents may have to be rejected, 0 only if none has."""
    layout = kind.layout
    root, columns = [c.name for c in layout.columns()], layout.item_columns()
    at = (*layout.exploded, layout.item.name)
    filled = _short(kind, names)
    others = [c.name for c in columns if c.name not in filled]
    short, long = layout.select(filled), layout.select(others) if others else None
    parsed = _parsed_twice(bronze, kind, short, long, names)
    if refused is not None:
        good = WELL_FORMED + (f" AND (rest IS NULL OR rest.{CORRUPT} IS NULL)" if others else "") + f" AND {_key(kind)} IS NOT NULL"
        parsed = parsed.observe(refused, F.expr(f"count_if(NOT ({good}))").alias("rows"))
    parsed = parsed.filter(f"{_key(kind)} IS NOT NULL")
    kept = (kind.sequence, "DHPROC_FORMATADO", *kind.metadata)
    path = ".".join(at)
    exploded = project(parsed, layout.columns(), *kept, f"posexplode(parsed.{path}) AS (place, item)", *(["rest"] if others else []))
    rest = [f"get(rest.{path}, place) AS rest"] if others else []
    rows = project(exploded, [c for c in columns if c.name in filled], *kept, *root, *rest, root="item")
    return Filing(with_partition_key(rows), _whole((*kept, *root), columns, filled))
