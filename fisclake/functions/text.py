"""Clean-up of the XML text as it leaves the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_line_breaks(text: str | Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def without_comments(text: str | Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def first_root(text: str | Column, roots: Sequence[str]) -> Column:
    """The first of ``roots`` that the text holds, from its opening to its closing tag; NULL if there is none."""
    found = [F.nullif(F.regexp_extract(text, rf"(?s)<{root}[\s>].*</{root}>", 0), F.lit("")) for root in roots]
    return F.coalesce(*found)


def clean_xml(text: str | Column, roots: Sequence[str] = ()) -> Column:
    cleaned = without_line_breaks(without_comments(text))
    return first_root(cleaned, roots) if roots else cleaned
