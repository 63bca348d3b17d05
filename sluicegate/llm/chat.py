"""Conversations as one training text each, by a grammar that reads them back exactly.

A turn is ``### Role: text``, a line break, ``</turn>`` and a line break; roles other than the three usual
ones are written as ``### =role: ``. Each turn is rendered plainly first and parsed again. Where role or
text come back changed, control strings in them get a backslash more than they have, and parsing takes one
off. Text under the loss mask is that of the assistant's turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicegate.llm.rows import map_arrow, map_rows, slices

NAMED = {"user": "User", "assistant": "Assistant", "system": "System"}
ROLES = {shown: role for role, shown in NAMED.items()}
END = "\n</turn>\n"
MASKED_ROLE = "assistant"
_CONTROL = re.compile(r"\\*(?:### (?:User|Assistant|System|=)|</turn>)")
_RUN = re.compile(r"\\+(?:### (?:User|Assistant|System|=)|</turn>)")
_HEAD = re.compile(r"(?s)### (?:(User|Assistant|System)|=((?:[^:\\]|\\.)*+)): ")


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _RUN.sub(lambda m: m[0][1:], text)


def _header(role: str) -> str:
    if role in NAMED:
        return f"### {NAMED[role]}: "
    return "### =" + re.sub(r"([:\\])", r"\\\1", role) + ": "


class GrammarError(ValueError):
    """A rendered text that is no sequence of turns."""


def parse(rendered: str) -> Iterator[tuple[str, str, int]]:
    """Role, text and the number of characters of each turn, from the left."""
    at = 0
    while at < len(rendered):
        head = _HEAD.match(rendered, at)
        end = rendered.find(END, head.end()) if head else -1
        if end < 0:
            raise GrammarError(f"no turn at character {at}")
        body = rendered[head.end() : end]
        bare = next((m for m in _CONTROL.finditer(body) if m[0][0] != "\\"), None)
        if bare:
            raise GrammarError(f"control string at character {head.end() + bare.start()}")
        role = ROLES[head[1]] if head[1] else re.sub(r"(?s)\\(.)", r"\1", head[2])
        after = end + len(END)
        yield role, unescaped(body), after - at
        at = after


def render(role: str, text: str) -> str:
    """The turn as plain as it comes back unchanged."""
    for content in (text, escaped(text)):
        rendered = _header(role) + content + END
        try:
            if [turn[:2] for turn in parse(rendered)] == [(role, text)]:
                return rendered
        except GrammarError:
            continue
    raise GrammarError("a turn does not come back unchanged")


TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("rendered", T.StringType()),
        T.StructField("mask_start", T.LongType()),
        T.StructField("mask_length", T.LongType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn rendered, with the place of its masked characters inside it (length 0: none).

    A conversation's training text is its turns by ``turn``, joined by nothing. Null text and null role are
    empty. Every turn is rendered and reparsed on its own, so a long conversation is spread over the tasks.
    """

    def rule(keys: list, turns: list, roles: list, texts: list) -> Iterator[tuple]:
        for key, turn, role, text in zip(keys, turns, roles, texts):
            rendered = render(role or "", text or "")
            head = len(_header(role or ""))
            masked = len(rendered) - head - len(END) if role == MASKED_ROLE else 0
            yield key, turn, rendered, head if masked else 0, masked

    return map_rows(conversations, ("conv_id", "turn", "role", "text"), rule, TURNS)


class _Fold:
    """What is read back of one conversation, turn by turn."""

    def __init__(self) -> None:
        self.turns, self.masked, self.chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int, length: int) -> None:
        for role, text, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        under = unescaped(rendered[start : start + length])
        self.masked += len(under)
        self.loss.update(under.encode("utf-8", "surrogatepass"))
        self.chars += len(rendered)

    def row(self, key: int | None) -> dict:
        values = (key, self.turns, self.all.hexdigest(), self.masked, self.loss.hexdigest(), self.chars)
        return dict(zip(DIGESTS.names, values))


def digest_conversations(turns: DataFrame) -> DataFrame:
    """Read rendered turns back, one row per conversation.

    A digest over a conversation needs its turns in order, so one task reads all turns of a conversation, as
    a stream: it holds a turn at a time and a hash state, however long the conversation is. Rows without
    conv_id are one conversation; equal turn numbers are ordered by what is rendered.
    """
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
    arrow = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in DIGESTS.names])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, current = None, None
        for batch in batches:
            for piece in slices(batch):
                done = []
                for key, rendered, start, length in zip(*(column.to_pylist() for column in piece.columns)):
                    if fold is None or key != current:
                        if fold is not None:
                            done.append(fold.row(current))
                        fold, current = _Fold(), key
                    fold.add(rendered, start, length)
                if done:
                    yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if fold is not None:
            yield pa.RecordBatch.from_pylist([fold.row(current)], schema=arrow)

    return map_arrow(ordered.select("conv_id", "rendered", "mask_start", "mask_length"), task, DIGESTS)
