"""Secret scan with a trigram inverted index, with DataFrame functions only.

All trigrams of all texts are indexed once. Each rule's regular expression yields a Boolean query over trigrams, whose postings are intersected to
candidates, and only those are verified by the expression; rules without mandatory trigrams scan everything. Rules added later ask the same index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import stored
from fisclake.llm.spans import located, occurrences

#: A query: any of the clauses, each a set of trigrams that must all occur. None: no trigram is mandatory.
Query = frozenset[frozenset[str]] | None
#: Strings that are followed up side by side while a query is derived.
_MOST = 64
#: Characters of a text whose trigrams are taken at a time.
_PART = 32_768


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[Column], Column] | None = None  # of a match


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
#: Base rules first (fixed patterns and lengths), then those that are added.
BASE = (
    Rule("assign", _ASSIGN, lambda said: F.char_length(F.regexp_extract(said, _ASSIGN, 1)) >= 6),
    Rule("access", "AKIA[A-Z0-9]++", lambda said: F.char_length(said) >= 20),
    Rule("hex", "(?<![0-9a-f])[0-9a-f]{24,}+"),
)
ADDED = (
    Rule("key", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----"),
    Rule("hub", "gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("maps", "AIza[0-9A-Za-z_-]{35}"),
)


def _clause(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _minimal(clauses: Iterable[frozenset[str]]) -> Query:
    """Without clauses that others imply; None if one is empty."""
    clauses = set(clauses)
    if frozenset() in clauses:
        return None
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    joined = _minimal(x | y for x in a for y in b)
    return joined if len(joined) <= _MOST else min(a, b, key=len)


def _strings(node: tuple) -> set[str] | None:
    """All strings that a node of the parsed expression matches, lower-cased, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL or k is op.RANGE and v[1] - v[0] < 8 for k, v in value):
        found = {chr(c).lower() for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1))}
        return found if len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[1] <= 3:
        own = _sequence(value[2])
        if own is None:
            return None
        result, power = set(), {""}
        for n in range(value[1] + 1):
            result |= power if n >= value[0] else set()
            power = {a + b for a in power for b in own}
        return result if len(result) <= _MOST else None
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}
    return None


def _sequence(nodes: Iterable[tuple]) -> set[str] | None:
    result = {""}
    for node in nodes:
        own = _strings(node)
        if own is None or len(result) * len(own) > _MOST:
            return None
        result = {a + b for a in result for b in own}
    return result


def _inside(node: tuple) -> Query:
    """What a node demands that has too many strings to list."""
    kind, value = node
    if kind is op.SUBPATTERN:
        return _demanded(value[-1])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        return _demanded(value[2]) if value[0] else None
    if kind is op.BRANCH:
        parts = [_demanded(p) for p in value[1]]
        return None if any(p is None for p in parts) else _minimal(c for p in parts for c in p)
    return None


def _demanded(nodes: Iterable[tuple]) -> Query:
    query, run = None, {""}
    for node in nodes:
        own = _strings(node)
        if own is not None and len(run) * len(own) <= _MOST:
            run = {a + b for a in run for b in own}
            continue
        query = _both(query, _minimal(map(_clause, run)))
        if own is None:
            query, run = _both(query, _inside(node)), {""}
        else:
            run = own
    return _both(query, _minimal(map(_clause, run)))


def trigram_query(pattern: str) -> Query:
    """The trigrams, lower-cased, without which ``pattern`` can't match."""
    return _demanded(_parser.parse(pattern))


@dataclass(frozen=True)
class TrigramIndex:
    """``rows`` (number, id, text) and the ``postings`` of every trigram of the lower-cased texts: trigram, ``word`` and ``bits``. Bit ``number % 64`` of
    word ``number / 64`` stands for a row. Both are stored; postings are sorted by trigram, so that a lookup skips what it doesn't ask for."""

    rows: DataFrame
    postings: DataFrame


def trigram_index(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> TrigramIndex:
    """Numbers the rows as they lie, so that the 64 of a word are read by one task and their postings merge before the shuffle.

    Null texts are empty; texts of less than three characters have no postings. Rows with the same or no id have numbers of their own.
    Long texts are cut into parts that overlap by two characters. No rows: no postings.
    """
    own = documents.select(F.monotonically_increasing_id().alias("number"), F.col(id_column).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = stored(own, "secret-rows")
    parts = F.regexp_extract_all(F.lower("text"), F.lit(f"(?s)(?=(.{{1,{_PART + 2}}}+)).{{1,{_PART}}}+"), F.lit(1))
    each = rows.select("number", F.explode(parts).alias("part")).select("number", F.explode(F.array_distinct(F.regexp_extract_all("part", F.lit("(?s)(?=(.{3}))"), F.lit(1)))).alias("trigram"))
    bit = F.expr("shiftleft(1L, cast(number & 63 AS int))")
    postings = each.groupBy("trigram", F.expr("shiftright(number, 6)").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return TrigramIndex(rows, stored(postings.sortWithinPartitions("trigram", "word"), "secret-postings"))


def candidates(index: TrigramIndex, rules: Iterable[Rule]) -> DataFrame:
    """For each ``word`` with candidates one column per rule that has a trigram query, under its kind: the bits of the rows that meet it.

    A clause intersects the postings of its trigrams, a rule unites its clauses. Words in which a trigram of a clause has no posting drop out.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    wanted = sorted({t for q in queries.values() for c in q for t in c})
    clauses = [
        F.struct(F.lit(t).alias("trigram"), F.lit(kind).alias("kind"), F.lit(n).alias("clause"), F.lit(len(c)).alias("size"))
        for kind, q in queries.items() for n, c in enumerate(sorted(map(sorted, q))) for t in c
    ]
    none = "array<struct<trigram:string,kind:string,clause:int,size:int>>"
    terms = index.rows.sparkSession.range(1).select(F.inline(F.array(*clauses).cast(none)))
    met = index.postings.filter(F.col("trigram").isin(wanted)).join(F.broadcast(terms), "trigram")
    both = met.groupBy("word", "kind", "clause", "size").agg(F.count("*").alias("n"), F.bit_and("bits").alias("bits")).filter("n = size AND bits <> 0")
    bits = [F.bit_or(F.when(F.col("kind") == kind, F.col("bits"))).alias(kind) for kind in queries]
    return both.groupBy("word").agg(F.count("*").alias("clauses"), *bits).drop("clauses")


def _verified(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The spans of each rule in ``rows``: of those with a trigram query only where their bit is set."""
    content = F.col("text")

    def asked(rule: Rule) -> Column | None:
        set_bit = F.expr(f"shiftright(`{rule.kind}`, cast(number & 63 AS int)) & 1L") == 1
        return F.coalesce(set_bit, F.lit(False)) if trigram_query(rule.pattern) is not None else None

    rows = rows.select("id", "text", *(occurrences(content, r.pattern, asked(r)).alias(f"m_{r.kind}") for r in rules))
    rows = rows.select("id", located(content, [r.pattern for r in rules], [F.col(f"m_{r.kind}") for r in rules]).alias("places"))
    return rows.select("id", *(_kept(F.col("places")[n], r).alias(r.kind) for n, r in enumerate(rules)))


def find_secrets(documents: DataFrame, id_column: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """Row by row: ``id`` and for each rule, under its kind, the spans it finds: code points, end exclusive, leftmost, not overlapping.

    Null and empty texts have no spans. Each row is indexed by itself, whatever its id. No rows: no rows. Other columns, whatever their
    names, are not looked at.
    """
    return secrets_in(trigram_index(documents, id_column, text), rules)


def secrets_in(index: TrigramIndex, rules: tuple[Rule, ...]) -> DataFrame:
    """``find_secrets`` over texts that are indexed already. Candidates are joined by word: a few bytes for 64 rows, so they are broadcast for long."""
    found = stored(candidates(index, rules), "secret-candidates")
    return _verified(index.rows.withColumn("word", F.expr("shiftright(number, 6)")).join(found, "word", "left"), rules)


def rows_with(index: TrigramIndex, rule: Rule) -> DataFrame:
    """``id`` and spans of the rows in which ``rule`` finds any: for a rule that is thought of later. Only the postings of its trigrams are read, only the
    texts of candidates verified; a rule without mandatory trigrams verifies all."""
    rows = index.rows.withColumn("word", F.expr("shiftright(number, 6)"))
    if trigram_query(rule.pattern) is not None:
        rows = rows.join(candidates(index, [rule]), "word").filter(F.expr(f"shiftright(`{rule.kind}`, cast(number & 63 AS int)) & 1L = 1"))
    return _verified(rows, (rule,)).filter(F.size(rule.kind) > 0)


def _kept(spans: Column, rule: Rule) -> Column:
    own = spans if rule.keep is None else F.filter(spans, lambda s: rule.keep(s["said"]))
    return F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def _ordered(rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of the rules' spans, by start, then in the order of the rules."""
    every = F.concat(*(F.transform(r.kind, _numbered(n)) for n, r in enumerate(rules)))
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(":", names[s["n"]], s["start"], s["end"])), ",")


def _numbered(n: int) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"))


def secrets_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    return found.select(
        F.col("id").alias(id_column), *(F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE), F.sha2(_ordered(BASE), 256).alias("base_sha256"), _ordered(BASE + ADDED).alias("spans")
    )
