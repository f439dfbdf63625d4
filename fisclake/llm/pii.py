"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier of spans decides.

DataFrame functions only: text is looked at by Spark's expressions, and what reaches the driver are counts of vote patterns and of feature
values, of which there is a fixed number whatever the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import stored, whole_row
from fisclake.llm.spans import blocks, cut, let, located, named, occurrences, overlapped, replaced

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns (fixed values). Quantifiers are possessive where nothing could be given back, so that no text takes long or deep
#: recursion; a match begins where a run of characters does, or where the last match ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns, whose matches are candidates.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\((?:at|AT)\)|\[(?:at|AT)\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\((?:dot|DOT)\)|\[(?:dot|DOT)\])\x20?[A-Za-z0-9-]{1,63}+){1,6}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9.])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9-])|(?<![0-9-])3[0-9]{3}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9-])",
    "phone": r"(?<![0-9+.])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])",
}
#: Where a cheap look says that a kind's patterns can't match, they aren't tried.
HINT = {"email": r"@|\(at\)|\(AT\)|\[at\]|\[AT\]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"[0-9][\x20().-]?[0-9]"}
#: A base phone may have any number of marks between its digits.
BASE_HINT = HINT | {"phone": r"\+[0-9]"}
#: Gazetteers: top-level domains, first digits of card issuers, country calling codes, network addresses that are nobody's.
DOMAINS = "com org net edu gov info io de fr es it uk eu nl ch at pl br mx ar us ca au in jp cn ru example".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|62|35)"
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
NOBODY = r"^(?:0|22[4-9]|2[3-5][0-9])\."
#: Words that stand before such data, and before other numbers.
SPEAKING = {"email": r"mail|contact|write|courriel|correo|kontakt", "ip": r"\bip\b|host|server|address|login|client", "card": r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", "phone": r"phone|tel|call|fax|mobil|sms|whatsapp"}
OTHER = r"isbn|version|\bv$|order|invoice|build|serial|article|\bno\.?\s*$"
BEFORE, AFTER = 30, 12

_VOTES = ("rule", "shape", "gazetteer", "context", "edge")
_FEATURES = ("length", "digits", "marks", "ahead", "behind", "words")


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _valid(kind: str) -> Callable[[Column], Column]:
    """Whether a span that matches the base pattern counts."""
    return lambda s: _counts(kind, s["said"])


def _counts(kind: str, said: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(said, r"\.", -1), lambda p: p.rlike(r"^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.char_length(_digits(said)).between(16, 19) & F.call_function("luhn_check", _digits(said))
    if kind == "phone":
        return F.char_length(_digits(said)).between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    """1, 0, or -1 for an abstention."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _votes(kind: str, said: Column, before: Column, after: Column) -> dict[str, Column]:
    digits, never = _digits(said), F.lit(False)
    speaking = F.lower(before).rlike(SPEAKING[kind])
    if kind == "email":
        rule = _vote(said.rlike(f"^{_LOCAL}+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+$"), never)
        shape = _vote(F.lower(said).rlike(r"[a-z].*[@)\]].*[.)\]]\x20?[a-z]{2,24}$"), said.rlike(r"[0-9-]$"))
        gazetteer = _vote(F.lower(F.regexp_extract(said, r"([A-Za-z]+)$", 1)).isin(DOMAINS), never)
    elif kind == "ip":
        rule = _vote(_counts("ip", said), said.contains("."))
        shape = _vote(said.contains(":") | said.rlike(r"[0-9]{2,3}.*\.[0-9]{2,3}"), said.rlike(r"^(?:[0-9]\.){3}[0-9]$"))
        gazetteer = _vote(never, said.rlike(NOBODY))
    elif kind == "card":
        rule = _vote(F.call_function("luhn_check", digits), F.lit(True))
        shape = _vote(said.rlike(r"^[0-9]{15,16}$|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), never)
        gazetteer = _vote(digits.rlike(ISSUERS), F.lit(True))
    else:
        rule = _vote(F.char_length(digits).between(9, 13), F.lit(True))
        shape = _vote(said.rlike(r"\(|^\+"), said.rlike(r"^(?:19|20)[0-9]{2}[.-]"))
        gazetteer = _vote(said.startswith("+") & digits.rlike(CALLING), said.startswith("+"))
    context = _vote(speaking, F.lower(before).rlike(OTHER))
    edge = _vote(never, before.rlike(r"[A-Za-z0-9_/=#]$") | after.rlike(r"^[A-Za-z0-9_/=%]"))
    return dict(zip(_VOTES, (rule, shape, gazetteer, context, edge), strict=True))


def _character(c: Column) -> Column:
    return F.when(c == "", "end").when(c.rlike(r"^\s$"), "space").when(c.rlike("^[0-9]$"), "digit").when(c.rlike(r"^\p{L}$"), "letter").otherwise("mark")


def _features(said: Column, before: Column, after: Column) -> dict[str, Column]:
    values = (
        F.least(F.floor(F.char_length(said) / 4), F.lit(8)), F.least(F.char_length(_digits(said)), F.lit(16)), F.least(F.char_length(F.regexp_replace(said, "[A-Za-z0-9]", "")), F.lit(8)),
        _character(F.right(before, F.lit(1))), _character(F.left(after, F.lit(1))), F.when(F.trim(before) == "", "none").when(before.rlike(r"\p{L}{2,}\W*$"), "word").otherwise("other"),
    )
    return {n: v.cast("string") for n, v in zip(_FEATURES, values, strict=True)}


def labelled(documents: DataFrame, id_column: str = "doc_id", text: str = "text", *keep: Column) -> DataFrame:
    """Row by row: ``id``, the base spans of each kind, and ``candidates`` with their votes and features."""
    rows = documents.select(F.col(id_column).alias("id"), F.coalesce(text, F.lit("")).alias("text"), *keep)
    content = F.col("text")
    # One step for the matches and one for their places: the places refer to the matches several times.
    rows = rows.withColumns({f"m_{k}": occurrences(content, p, content.rlike(BASE_HINT[k])) for k, p in BASE.items()} | {f"w_{k}": occurrences(content, p, content.rlike(HINT[k])) for k, p in WIDE.items()})
    patterns = [*BASE.values(), *WIDE.values()]
    rows = rows.withColumn("places", located(content, patterns, [F.col(f"{c}_{k}") for c in "mw" for k in KINDS]))
    rows = rows.withColumns({k: F.filter(F.col("places")[n], _valid(k)) for n, k in enumerate(KINDS)} | {f"c_{k}": F.col("places")[len(KINDS) + n] for n, k in enumerate(KINDS)})
    tagged = [F.transform(f"c_{k}", _of_kind(k)) for k in KINDS]
    rows = rows.withColumn("judged", let(F.concat(*tagged), lambda c: F.when(F.size(c) > 0, overlapped(c, F.concat(*KINDS), _CANDIDATE))))

    def described(kind: str, parts: Column) -> Callable[[Column], Column]:
        def describe(j: Column) -> Column:
            s = j["span"]
            before = cut(parts, F.greatest(s["start"] - BEFORE, F.lit(0)), s["start"])
            after = cut(parts, s["end"], s["end"] + AFTER)
            around = F.struct(s["said"].alias("said"), before.alias("before"), after.alias("after"))
            return let(around, lambda x: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), j["known"].alias("known"),
                *(v.cast("int").alias(n) for n, v in _votes(kind, x["said"], x["before"], x["after"]).items()), *(v.alias(n) for n, v in _features(x["said"], x["before"], x["after"]).items()),
            ))

        return describe

    def of_all(judged: Column, parts: Column) -> Column:
        return F.concat(*(F.transform(F.filter(judged, _is_kind(k)), described(k, parts)) for k in KINDS))

    # Texts without candidates aren't cut.
    none = F.array().cast(f"array<struct<span:{_CANDIDATE},known:boolean>>")
    candidates = let(F.coalesce("judged", none), lambda j: let(F.when(F.size(j) > 0, blocks(content)), lambda b: of_all(j, b)))
    places = {k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS}
    return rows.select("id", *(c for c in rows.columns if c == "kept"), *(c.alias(k) for k, c in places.items()), candidates.alias("candidates"))


_CANDIDATE = "struct<start:int,end:int,kind:string,said:string>"


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["said"].alias("said"))


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda j: j["span"]["kind"] == kind


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 100) -> dict[tuple[str, tuple[int, ...]], float]:
    """Probability that a candidate of each kind and vote pattern is personal data, by expectation-maximisation over the patterns' counts.

    Each labeler votes 1, 0 or abstains with probabilities that depend on the kind and on whether the span is personal data. It starts
    from the belief that labelers are better than chance, and one vote of each sort is added to what is counted.
    """
    result: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in {k for k, _, _ in patterns}:
        own = [(votes, n) for k, votes, n in patterns if k == kind]
        belief = {v: (1 + sum(x == 1 for x in v)) / (2 + sum(x >= 0 for x in v)) for v, _ in own}
        for _ in range(rounds):
            total = [1.0 + sum(n * (1 - belief[v]) for v, n in own), 1.0 + sum(n * belief[v] for v, n in own)]
            chance = [
                [
                    {x: ((2 if x == y else 1) + sum(n * (belief[v] if y else 1 - belief[v]) for v, n in own if v[j] == x)) / (total[y] + 3) for x in (-1, 0, 1)}
                    for j in range(len(_VOTES))
                ]
                for y in (0, 1)
            ]
            for v, _ in own:
                log = [math.log(total[y] / sum(total)) + sum(math.log(chance[y][j][x]) for j, x in enumerate(v)) for y in (0, 1)]
                belief[v] = 1 / (1 + math.exp(min(700, log[0] - log[1])))
        result |= {(kind, v): b for v, b in belief.items()}
    return result


def _lookup(values: dict[str, float], key: Column, otherwise: float) -> Column:
    if not values:
        return F.lit(otherwise)
    table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return F.coalesce(F.try_element_at(table, key), F.lit(otherwise))


def _key(*parts: Column) -> Column:
    return F.concat_ws("|", *parts)


def classifier(rows: DataFrame):
    """The trained span classifier: log-odds of a candidate as a function of its struct. Sees all candidates of all rows."""
    each = rows.select(F.explode("candidates").alias("c")).select("c.*")
    counted = each.groupBy("kind", *_VOTES).agg(F.count("*").alias("n")).collect()  # at most 4 kinds x 3 ** 5 patterns
    belief = reliabilities([(r["kind"], tuple(r[v] for v in _VOTES), r["n"]) for r in counted])
    soft = {"|".join([k, *map(str, v)]): b for (k, v), b in belief.items()}
    weighed = each.withColumn("p", _lookup(soft, _key("kind", *(F.col(v).cast("string") for v in _VOTES)), 0.5))
    # Naive Bayes on the votes' verdict and the features, fitted to the soft labels: sums over all candidates.
    features = F.explode(F.array(F.struct(F.lit("").alias("f"), F.lit("").alias("v")), *(F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in _FEATURES)))
    sums = weighed.select("kind", "p", features.alias("x")).groupBy("kind", "x.f", "x.v").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    totals = {r["kind"]: (r["yes"] + 1, r["no"] + 1) for r in sums if r["f"] == ""}
    weights = {f"{r['kind']}|{r['f']}|{r['v']}": math.log((r["yes"] + 1) / (totals[r["kind"]][0] + 8)) - math.log((r["no"] + 1) / (totals[r["kind"]][1] + 8)) for r in sums if r["f"]}
    verdict = {k: math.log(max(b, 1e-9)) - math.log(max(1 - b, 1e-9)) for k, b in soft.items()}

    def log_odds(c: Column) -> Column:
        total = _lookup(verdict, _key(c["kind"], *(c[v].cast("string") for v in _VOTES)), 0.0)
        for f in _FEATURES:
            total = total + _lookup({k: w for k, w in weights.items() if k.split("|")[1] == f}, _key(c["kind"], F.lit(f), c[f]), 0.0)
        return total

    return log_odds


def find_pii(documents: DataFrame, id_column: str = "doc_id", text: str = "text", *keep: Column) -> DataFrame:
    """Row by row: ``id``, the base spans by kind, and ``added``: further spans (``kind``, ``start``, ``end``) that the trained classifier
    takes for personal data. Spans are in code points, end exclusive; added ones overlap no base span.

    Null and empty texts have no spans. Repeated rows and ids: one result each. No rows: no rows. Other columns, whatever their names,
    are not looked at.
    """
    rows = stored(labelled(documents, id_column, text, *keep), "pii")
    log_odds = classifier(rows)
    added = F.filter("candidates", lambda c: ~c["known"] & (log_odds(c) >= 0))
    return rows.withColumn("added", F.transform(added, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))).drop("candidates")


def _tagged(name: str, value: Column) -> Callable[[Column], Column]:
    return lambda s: F.struct(value.alias(name), s["start"].alias("start"), s["end"].alias("end"))


def _labelled(label: Column) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label.alias("label"))


def pii_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    base = F.concat(*(named(k, F.col(k)) for k in KINDS))
    every = F.concat(*(F.transform(k, _tagged("n", F.lit(n))) for n, k in enumerate(KINDS)),
        F.transform("added", lambda s: F.struct((F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]) - 1).cast("int").alias("n"), s["start"].alias("start"), s["end"].alias("end"))))
    names = F.array(*map(F.lit, KINDS))
    said = F.transform(F.array_sort(every), lambda s: F.concat_ws(":", names[s["n"]], s["start"], s["end"]))
    return found.select(
        F.col("id").alias(id_column), *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(said, ",").alias("spans")
    )


def redact(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in brackets; null texts stay null."""
    found = find_pii(documents, id_column, text, whole_row(documents))
    label = lambda k: F.concat(F.lit("["), F.upper(k), F.lit("]"))
    every = F.concat(*(F.transform(k, _labelled(label(F.lit(k)))) for k in KINDS),
        F.transform("added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), label(s["kind"]).alias("label"))))
    place = f"kept.c{documents.columns.index(text)}"
    found = found.withColumn("every", F.array_sort(every)).withColumn("new", replaced(F.col(place), F.col("every")))
    return found.select(*(F.col("new" if c == text else f"kept.c{n}").alias(c) for n, c in enumerate(documents.columns)))
