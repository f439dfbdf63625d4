import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from fisclake.llm.chat import CONTROLS, assemble, escape, format_conversations, read_back, unescape
from fisclake.llm.queries import HOSTILE, QUERIES, table

PIECES = st.lists(st.sampled_from([*CONTROLS, *(c[0] + "\\" + c[1:] for c in CONTROLS), "<", "[", "\\", "/", "s>", "INST]", "x", " ", "é", "\U0001f600"]), max_size=12)


@settings(max_examples=500, deadline=None)
@given(PIECES.map("".join))
def test_escape_is_reversible_and_safe(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES.map("".join), min_size=1, max_size=4))
def test_formatted_text_can_be_taken_apart(texts):
    """Contents beside control strings make no further ones."""
    said = "".join(f"[INST]{escape(t)}[/INST]{escape(t)}</s>" for t in texts)
    assert [said.count(c) for c in CONTROLS] == [0, *(len(texts),) * 3]


def test_mask_by_prefix_sums():
    ids = dict(zip(CONTROLS, range(100, 104), strict=True))
    tokens, loss = assemble([(False, [1], [2, 3]), (True, [4], [5, 6]), (True, [4], []), (True, [4], [7])], ids)
    assert tokens.tolist() == [100, 101, 1, 102, 2, 3, 103, 101, 4, 102, 5, 6, 103, 101, 4, 102, 103, 101, 4, 102, 7, 103]
    assert tokens[loss].tolist() == [5, 6, 7]


def test_query_equals_plain_digests(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    turns = {}
    for conv, _, role, text in sorted(rows, key=lambda r: r[:2]):
        turns.setdefault(conv, []).append((role, text or ""))
    found = {r["conv_id"]: r for r in QUERIES["op5_chat_formatting"](spark, sf_dir).collect()}
    assert found.keys() == turns.keys()
    for conv, own in turns.items():
        learnt = "".join(t for r, t in own if r == "assistant")
        formatted = "<s>" + "".join(f"[INST]{r}[/INST]{escape(t)}</s>" for r, t in own)
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), brute.sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == (len(learnt), brute.sha(learnt), len(formatted))


def test_odd_rows(spark):
    long = "Wort \U0001f600 " * 20_000
    rows = [
        (1, 1, "assistant", None), (1, 0, "user", ""), (2, None, None, None), (2, 0, "[INST]", "a"), (2, 0, "[INST]", "a"), (3, 5, "assistant", long),
        (3, 6, "assistant", long), (None, 0, "assistant", "no id"), (4, 0, "assistant", "b"), (4, 0, "assistant", "a"),
    ]
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, conv int, tokens string, learnt string")
    formatted = format_conversations(frame)
    back = {r["conv_id"]: r for r in read_back(formatted).collect()}
    turns = {k: [tuple(t) for t in r["turns"]] for k, r in back.items()}
    assert turns[1] == [("user", ""), ("assistant", "")] and back[1]["learnt"] == ""
    assert turns[2] == [("", ""), ("[INST]", "a"), ("[INST]", "a")]
    assert back[3]["learnt"] == long * 2 and back[None]["learnt"] == "no id"
    assert sorted(turns[4]) == [("assistant", "a"), ("assistant", "b")]
    for r in formatted.collect():
        assert len(r["tokens"]) == len(r["loss"]) and r["formatted"].startswith("<s>")
    assert format_conversations(frame.limit(0)).collect() == []
    assert np.all([r["formatted_chars"] > 0 for r in back.values()])
