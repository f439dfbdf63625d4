"""Chat formatting on tokens: segments are encoded apart, reserved ids set between them, and the loss mask derived from their lengths."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A byte-level vocabulary in tiktoken's format: any text can be encoded, and decodes to itself.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary cuts texts (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A conversation is BEGIN and its turns; a turn is OPEN role CLOSE text END.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (BEGIN, OPEN, CLOSE, END)
LOSS_ROLE = "assistant"

# A control string in a text gets a backslash after its first character; one that has some there already gets one more.
_OCCURS = re.compile("|".join(rf"(?:{re.escape(c[0])})(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"({re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    """No control string occurs in the result. Reversed by ``unescape``, for any text."""
    return _OCCURS.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0], text)


@cache
def encoding(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """The tokenizer, and ids behind its own for the control strings."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    plain = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return plain, {c: max(ranks.values()) + 1 + n for n, c in enumerate(CONTROLS)}


def assemble(turns: list[tuple[bool, list[int], list[int]]], ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and loss mask of a conversation; a turn is (whether it counts for the loss, tokens of the role, tokens of the text)."""
    parts: list[list[int]] = [[ids[BEGIN]]]
    counts = [False]
    for learnt, role, text in turns:
        parts += [[ids[OPEN]], role, [ids[CLOSE]], text, [ids[END]]]
        counts += [False, False, False, learnt, False]
    lengths = np.array([len(p) for p in parts])
    ends = np.cumsum(lengths)
    change = np.zeros(ends[-1] + 1, np.int64)
    np.add.at(change, (ends - lengths)[counts], 1)
    np.subtract.at(change, ends[counts], 1)
    return np.concatenate([np.asarray(p, np.int32) for p in parts]), np.cumsum(change)[:-1] > 0


def format_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per conversation: ``conversation``, ``tokens``, ``loss`` (whether each token is learnt) and ``formatted`` (the same as text).

    Texts and roles are escaped and encoded row by row, where the rows are; only their tokens are gathered by conversation. Content
    can't yield a reserved id, and in ``formatted`` no control string. Learnt are the tokens of the assistant's texts.

    Null text or role: empty. Null turns come first; rows of the same turn are ordered by the tokens of role and text. A null
    conversation is one like any other. Repeated rows are repeated turns. No rows: no rows. Other columns, whatever their names, are not
    looked at. A conversation is one row of the result, so its tokens have to fit into a task.
    """
    plain = rows.select(
        F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = encoding(vocabulary)
        known: dict[str, list[int]] = {}
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            for r in set(roles) - known.keys():
                known[r] = tokenizer.encode_ordinary(escape(r))
            column = [pa.array(x, pa.list_(pa.int32())) for x in ([known[r] for r in roles], [tokenizer.encode_ordinary(escape(t)) for t in texts])]
            learnt = pa.array([r == LOSS_ROLE for r in roles])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("turn"), learnt, *column], ["conv", "turn", "learnt", "role", "text"])
            known.clear() if len(known) > 10_000 else None

    encoded = plain.mapInArrow(encode, "conv long, turn long, learnt boolean, role array<int>, text array<int>")
    grouped = encoded.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "learnt"))).alias("turns"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ids = encoding(vocabulary)
        strings = {i: c.encode() for c, i in ids.items()}
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                made = [assemble([(t["learnt"], t["role"], t["text"]) for t in turns], ids) for turns in part.column("turns").to_pylist()]
                said = [b"".join(strings.get(s[0]) or tokenizer.decode_bytes(s) for s in segments(tokens, ids)).decode() for tokens, _ in made]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), pa.array([t for t, _ in made], pa.list_(pa.int32())), pa.array([m for _, m in made], pa.list_(pa.bool_())), pa.array(said, pa.string())],
                    ["conv", "tokens", "loss", "formatted"],
                )

    result = grouped.mapInArrow(join, "conv long, tokens array<int>, loss array<boolean>, formatted string")
    return result.withColumnRenamed("conv", conversation)


def segments(tokens: np.ndarray, ids: dict[str, int]) -> Iterator[list[int]]:
    """The tokens cut before and behind every reserved id; nothing empty."""
    special = np.flatnonzero(np.isin(tokens, list(ids.values())))
    cuts = np.unique(np.r_[0, special, special + 1, len(tokens)])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield tokens[a:b].tolist()


def read_back(formatted: DataFrame, conversation: str = "conv_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """What the tokens and the mask say: ``conversation``, ``turns`` (role and text of each) and ``learnt`` (all text under the mask);
    and the code points of ``formatted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ids = encoding(vocabulary)
        name = {i: c for c, i in ids.items()}

        def text(tokens: list[int]) -> str:
            return unescape(tokenizer.decode_bytes(tokens).decode())

        for batch in batches:
            turns, learnt = [], []
            for tokens, loss in zip(batch.column("tokens"), batch.column("loss"), strict=True):
                tokens, loss = np.asarray(tokens.values), np.asarray(loss.values.to_numpy(zero_copy_only=False), bool)
                own, at = [], None
                for part in segments(tokens, ids):
                    control = name.get(part[0])
                    if control == OPEN:
                        own.append({"role": "", "text": ""})
                        at = "role"
                    elif control == CLOSE:
                        at = "text"
                    elif control is None:
                        own[-1][at] = text(part)
                edges = np.flatnonzero(np.diff(np.r_[False, loss, False].astype(np.int8)))
                turns.append(own)
                learnt.append("".join(text(tokens[a:b].tolist()) for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
            chars = pc.utf8_length(batch.column("formatted")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(turns, kind), pa.array(learnt, pa.string()), chars], ["conv", "turns", "learnt", "formatted_chars"])

    rows = formatted.select(F.col(conversation).alias("conv"), "tokens", "loss", "formatted")
    return rows.mapInArrow(run, "conv long, turns array<struct<role:string,text:string>>, learnt string, formatted_chars long").withColumnRenamed("conv", conversation)

