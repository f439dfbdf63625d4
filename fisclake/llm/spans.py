"""Spans of patterns in texts, with DataFrame functions only, in time that grows with the text and its spans."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a span is held: code points, end exclusive.
SPAN = "struct<start:int,end:int,said:string>"
#: Code points of the blocks that a text is cut into before pieces of it are taken, and numbers that are added up together.
BLOCK, TOGETHER = 256, 256
_LAST = 2**31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running totals of integers by an associative ``step`` from its neutral ``start``.

    Appending to an array copies it, so the values are taken ``TOGETHER`` at a time.
    """
    none = F.array().cast("array<int>")

    def folded(part: Column, begin: Column, own: bool) -> Column:
        def add(state: Column, x: Column) -> Column:
            total = step(state["at"], x).cast("int")
            return F.struct(total.alias("at"), F.array_append(state["all"], total if own else state["at"]).alias("all"))

        return F.aggregate(part, F.struct(begin.cast("int").alias("at"), none.alias("all")), add, lambda s: s["all"])

    def whole(values: Column) -> Column:
        last = ((F.size(values) - 1) / TOGETHER).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * TOGETHER + 1, F.lit(TOGETHER)))
        return let(parts, lambda p: F.flatten(F.zip_with(p, folded(F.transform(p, lambda x: F.aggregate(x, start.cast("int"), lambda a, b: step(a, b).cast("int"))), start, False), lambda x, at: folded(x, at, True))))

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def occurrences(text: Column, pattern: str, only_if: Column | None = None) -> Column:
    """The matches of ``pattern`` in ``text``, leftmost and not overlapping; none where ``only_if`` doesn't hold."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if only_if is None else F.when(only_if, found).otherwise(F.array().cast("array<string>"))


def located(text: Column, patterns: Sequence[str], found: Sequence[Column]) -> Column:
    """For each pattern, in one array, the spans of what ``occurrences`` gave: the lengths of what stands between the matches say where they are."""
    none = F.array().cast("array<string>")

    def parted(pattern: str, found: Column) -> Column:
        return F.struct(found.alias("found"), F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(none).alias("gaps"))

    def placed(pair: Column) -> Column:
        gaps = F.slice(pair["gaps"], F.lit(1), F.size(pair["found"]))
        ends = running(F.zip_with(gaps, pair["found"], lambda gap, said: F.char_length(gap) + F.char_length(said)), F.lit(0), lambda a, b: a + b)
        return F.zip_with(pair["found"], ends, lambda said, end: F.struct((end - F.char_length(said)).alias("start"), end.alias("end"), said.alias("said")))

    return F.transform(F.array(*map(parted, patterns, found)), placed).cast(f"array<array<{SPAN}>>")


def named(kind: str, spans: Column) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def blocks(text: Column) -> Column:
    """``text`` in blocks of ``BLOCK`` code points, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of the text, or to its end: only the blocks that hold them are looked at."""
    first, last = (start / BLOCK).cast("int"), ((end - 1) / BLOCK).cast("int")
    whole = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(whole, start % BLOCK + 1, end - start)).otherwise("")


def overlapped(spans: Column, others: Column, kind: str) -> Column:
    """``spans`` (of type ``kind``) in order of their starts, each with whether one of ``others`` overlaps it: structs of ``span`` and ``known``. None of them is empty."""
    mine = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("tag"), s["end"].alias("end"), s.alias("span")))
    theirs = F.transform(others, lambda o: F.struct(o["start"].alias("start"), F.lit(0).alias("tag"), o["end"].alias("end"), F.lit(None).cast(kind).alias("span")))

    def judged(events: Column) -> Column:
        # The furthest end of others so far, and the nearest start of one to come.
        reach = running(F.transform(events, lambda e: F.when(e["tag"] == 0, e["end"]).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
        ahead = running(F.reverse(F.transform(events, lambda e: F.when(e["tag"] == 0, e["start"]).otherwise(_LAST))), F.lit(_LAST), lambda a, b: F.least(a, b))
        around = F.zip_with(reach, F.reverse(ahead), lambda r, a: F.struct(r.alias("reach"), a.alias("ahead")))
        known = F.zip_with(events, around, lambda e, x: F.struct(e["tag"].alias("tag"), e["span"].alias("span"), ((x["reach"] > e["start"]) | (x["ahead"] < e["end"])).alias("known")))
        return F.transform(F.filter(known, lambda k: k["tag"] == 1), lambda k: F.struct(k["span"].alias("span"), k["known"].alias("known")))

    return let(F.array_sort(F.concat(mine, theirs)), judged)


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with every span (structs of ``start``, ``end``, ``label``; sorted by start) replaced by its label. Of overlapping spans
    the label of the first stands for all they cover."""

    def written(spans: Column, parts: Column) -> Column:
        ends = running(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        before = F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), F.size(spans))
        said = F.zip_with(spans, before, lambda s, at: F.when(s["start"] >= at, F.concat(cut(parts, at, s["start"]), s["label"])).otherwise(""))
        return F.concat(F.array_join(said, ""), cut(parts, F.array_max(ends), F.char_length(text)))

    return F.when(F.size(spans) > 0, let(spans, lambda s: let(blocks(text), lambda b: written(s, b)))).otherwise(text)
