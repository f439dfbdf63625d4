import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from fisclake.llm import conversations
from fisclake.llm.conversations import conversation_digest, edits, entrances, joined, parse, repair_conversations
from fisclake.llm.queries import QUERIES, table

FORM = re.compile(r"(s?(ua)+)?")
GOOD = re.compile(r"(s?(ua)*u?)?")  # what can still become one


def cheapest(codes):
    """All edits that could be worth it, one at a time."""
    best = None

    def inserted(ways):
        more = {}
        for (roles, audit), cost in ways.items():
            for extra in ("", "u", "a", "ua", "au"):
                for n in range(2) if extra else range(1):
                    new = roles + extra * (n + 1)
                    if GOOD.fullmatch(new):
                        key = (new, audit + "I" * (len(new) - len(roles)))
                        more[key] = min(more.get(key, 10**9), cost + 3 * (len(new) - len(roles)))
        return more

    ways = {("", ""): 0}  # roles so far, audit: cost
    for code in codes:
        after = {}
        for (roles, audit), cost in inserted(ways).items():
            options = [("D", roles, 4)]
            if code != "d":
                more = 3 if code.isupper() else 0
                options += [("K", roles + code.lower(), more), *(("R", roles + s, 3 + more) for s in "ua")]
            for edit, new, price in options:
                if GOOD.fullmatch(new):
                    key = (new, audit + edit)
                    after[key] = min(after.get(key, 10**9), cost + price)
        ways = after
    for (roles, audit), cost in inserted(ways).items():
        if FORM.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
    return best


def chosen(codes):
    ends = conversations.automaton()[2]
    return min(top for state, top in parse(codes, [1] * len(codes)).items() if ends[state])


@settings(max_examples=100, deadline=None)
@given(st.text("suaxSUAXd", max_size=4))
def test_parse_finds_the_cheapest_edits(codes):
    assert chosen(codes) == cheapest(codes)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("suaxSUAXd", max_size=6), min_size=1, max_size=4))
def test_pieces_join_to_the_whole(parts):
    whole = "".join(parts)
    tables = [{e: parse(p, [1] * len(p), e) for e in entrances()} for p in parts]
    cost, steps = joined(tables)
    audit = "".join(t[a][b][1] for t, (a, b) in zip(tables, steps, strict=True))
    assert (cost, audit) == chosen(whole)
    roles = "".join(
        (role or whole_role)[0]
        for t, p, (a, b) in zip(tables, parts, steps, strict=True)
        for edit, at, role in edits(p, [1] * len(p), t[a][b][1], a)
        for whole_role in [p[at].lower() if at >= 0 else ""]
    )
    assert FORM.fullmatch(roles)


def test_a_turn_that_goes_many_times():
    assert chosen("uddda") == min(top for state, top in parse("uda", [1, 3, 1]).items() if conversations.automaton()[2][state]) == (12, "KDDDK")
    assert list(edits("uda", [1, 3, 1], "KDDDK", 0)) == [("K", 0, None), ("K", 2, None)]


def plain(rows):
    """``rows``: (turn, role, text) in order; the columns of the query but the id."""
    seen, codes, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for _, role, text in rows:
        said = text.strip("\t\n\x0b\x0c\r ")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not said:
            counts["blank"] += 1
            codes += "d"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            codes += "d"
        elif said[-1] not in ".!?":
            counts["truncated"] += 1
            codes += initial.upper()
        else:
            codes += initial
        seen.add((role, text))
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = solve(codes)
    out, left, expected = [], list(rows), ""
    for edit in audit:
        if edit == "D":
            left.pop(0)
        elif edit == "I":
            out.append((expected or "user", ""))
        elif edit == "R":
            out.append((expected or "user", left.pop(0)[2]))
        else:
            out.append(left.pop(0)[1:])
        if edit != "D":
            expected = "assistant" if out[-1][0][:1] == "u" else "user"
    return (gaps, *counts.values(), cost, audit, brute.sha("\n".join(f"{r}:{t}" for r, t in out)))


@cache
def solve(codes):
    """Dynamic programming over the form as a plain automaton: start, behind s, behind u, behind a pair."""
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for s in "ua":
                    if s in moves[state]:
                        new = (cost + 3, audit + "I")
                        best[moves[state][s]] = min(best.get(moves[state][s], new), new)
        return best

    for code in codes:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            more = 3 if code.isupper() else 0
            options = [(state, 4, "D")] + ([] if code == "d" else [(moves[state].get(code.lower()), more, "K"), *((moves[state].get(s), 3 + more, "R") for s in "ua")])
            for target, price, edit in options:
                if target is not None:
                    new = (cost + price, audit + edit)
                    after[target] = min(after.get(target, new), new)
        best = after
    return min(top for state, top in inserted(best).items() if state in (0, 3))


def damage(rows):
    for conv, turn, role, text in rows:
        said = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(said).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def by_conversation(rows):
    found = {}
    for conv, *row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append(tuple(row))
    return found


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_plain_repair(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    expected = by_conversation(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    found = {r["conv_id"]: r for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert found.keys() == {r[0] for r in rows}
    for conv, row in found.items():
        assert tuple(row[c] for c in names) == (plain(expected[conv]) if conv in expected else empty)


@pytest.mark.parametrize("piece", [2, 1024])
def test_odd_rows(spark, piece):
    long = "Wort " * 30_000 + "."
    rows = [
        (1, None, "user", "a."), (1, 3, None, "b."), (1, 2, "assistant", None), (1, 9, "assistant", "c."), (2, None, None, None), (3, 0, "assistant", long), (3, 1, "assistant", long),
        (None, 0, "user", "Hi!"), (None, 2, "assistant", "x"), (4, 0, "", "Ünïcode ſ 漢字 \U0001f600?"), (4, 1, "tool", "t."), (5, 0, "user", "\t\n"), (6, 0, "system", "s."),
        *((7, n, "user" if n % 2 else "assistant", f"{n % 40}.") for n in range(90)), *[(8, 1, "user", "again.")] * 50, (8, 2, "assistant", "yes."),
    ]
    frame = spark.createDataFrame([(*r, 1, "x", "y", 3) for r in rows], "conv_id long, turn long, role string, text string, conv int, h string, audit string, position int").repartition(5)
    found, turns = repair_conversations(frame, piece=piece)
    expected = {c: plain([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in own]) for c, own in by_conversation(rows).items()}
    digest = {r["conv_id"]: r["repaired_sha256"] for r in conversation_digest(turns).collect()}
    own = {r["conv_id"]: (*list(r)[1:], digest.get(r["conv_id"], brute.sha(""))) for r in found.collect()}
    assert own == expected
    for conv in expected:
        roles = [r["role"] for r in sorted(turns.filter(turns.conv_id.eqNullSafe(conv)).collect(), key=lambda r: r["position"])]
        assert FORM.fullmatch("".join(r[:1] for r in roles))
    assert all(df.collect() == [] for df in repair_conversations(frame.limit(0)))
