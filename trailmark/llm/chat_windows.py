"""Chat formatting in budgeted windows.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts each ``<`` that is followed by
any number of backslashes and ``|`` gets one backslash more after it, so the template's marks cannot
occur there, and taking one away restores the text; in roles backslashes and line ends are escaped as well.

Running sums of turn tokens choose windows that start and end at turns: a window holds the system turn
(if the conversation starts with one), up to ``history`` tokens of earlier turns, and as many new turns
as the budget allows, at least one.  Loss spans cover the texts of new assistant turns only; repeated turns
are masked, so each assistant text is a target once.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import frugal

START, END = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)
WINDOW_SCHEMA = "conv_id long, window int, formatted string, tokens long, first_new int, history_turns int, has_system boolean, loss_spans array<struct<begin:int,end:int>>"


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@contextmanager
def _counter(path: str | None):
    """Tokens of each formatted turn: by a tokenizer file, or one for four bytes where there is none."""
    if path is None:
        yield lambda turns: [len(t.encode()) // 4 + 1 for t in turns]
        return
    from .chunk_encoder import ByteLevelEncoder, encoder

    with encoder(ByteLevelEncoder, path) as enc:
        yield lambda turns: [len(x) for x in enc.encode(turns)]


class _Conversation:
    """Turns of one conversation as they come; holds no more than a window and the history behind it."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system = None
        self.sums = [0]
        self.turns: list[tuple[str, str, str, int]] = []  # formatted, role, escaped text, tokens
        self.new = 0  # first new turn, as an index of turns
        self.seen = self.window = 0

    def add(self, role: str, body: str, formatted: str, tokens: int):
        if not self.seen and role == "system":
            self.system = (formatted, tokens)
        fixed = self.system[1] if self.system else 0
        whole = (fixed if self.sums[0] == 0 and not self._has_first() else 0) + self.sums[-1] - self.sums[0] + tokens
        if len(self.turns) > self.new and whole > self.budget:
            yield self.row()
            self._slide(tokens, fixed)
        self.turns.append((formatted, role, body, tokens))
        self.sums.append(self.sums[-1] + tokens)
        self.seen += 1

    def _has_first(self) -> bool:
        """Whether the turns at hand begin with the conversation's first."""
        return self.seen == len(self.turns)

    def _slide(self, tokens: int, fixed: int):
        """Keep as history the last turns that fit: the new turn, the system turn and they within the budget."""
        room = min(self.history, self.budget - fixed - tokens)
        first = len(self.turns)
        while first > 0 and self.sums[-1] - self.sums[first - 1] <= room and not (self.system and self._has_first() and first == 1):
            first -= 1
        if self.system and self._has_first():
            first = max(first, 1)
        del self.turns[:first]
        self.sums = [s - self.sums[first] for s in self.sums[first:]]
        self.new = len(self.turns)

    def row(self) -> tuple:
        text, spans, at = [], [], 0
        apart = self.system is not None and not self._has_first()
        if apart:
            text.append(self.system[0])
            at = len(text[0])
        for k, (formatted, role, body, _) in enumerate(self.turns):
            if k >= self.new and role == "assistant" and body:
                end = at + len(formatted) - len(END) - 1
                spans.append({"begin": end - len(body), "end": end})
            text.append(formatted)
            at += len(formatted)
        tokens = self.sums[-1] - self.sums[0] + (self.system[1] if apart else 0)
        out = (self.conv_id, self.window, "".join(text), tokens, self.seen - len(self.turns) + self.new, self.new, apart, spans)
        self.window += 1
        return out


_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]

def _format(budget: int, history: int, tokenizer: str | None):
    def task(batches):
        now, rows, size = None, [], 0

        def table():
            out = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, _TYPES, strict=True)], names=["conv_id", "window", "formatted", "tokens", "first_new", "history_turns", "has_system", "loss_spans"])
            rows.clear()
            return out

        with _counter(tokenizer) as count:
            for batch in batches:
                ids, roles, texts = (batch.column(k).to_pylist() for k in range(3))
                bodies = [escape(t or "") for t in texts]
                turns = [f"{START}{escape_role(r or '')}\n{b}{END}\n" for r, b in zip(roles, bodies, strict=True)]
                for conv_id, role, body, turn, tokens in zip(ids, roles, bodies, turns, count(turns), strict=True):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            rows.append(now.row())
                            size += len(rows[-1][2])
                        now = _Conversation(conv_id, budget, history)
                    for row in now.add(role or "", body, turn, tokens):
                        rows.append(row)
                        size += len(row[2])
                    if size > 1 << 22:
                        yield table()
                        size = 0
        if now is not None:
            rows.append(now.row())
        yield table()

    return frugal(task)


def chat_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = 512, history: int = 128, tokenizer: str | None = None) -> DataFrame:
    """One row per window, in order within each conversation: conv_id, window, formatted, tokens, first_new, history_turns, has_system, loss_spans.

    Null roles and texts are empty.  Turns with the same or a null number are ordered by role and text (nulls
    first); rows with a null conversation form one conversation.  A turn larger than the budget has a window of its own with the
    system turn and no history.  An empty table gives no windows; other columns are ignored.
    """
    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(budget, history, tokenizer), WINDOW_SCHEMA)


def parse(formatted: str) -> list[tuple[str, str, int]]:
    """(role, text, begin of the escaped text) of each turn of a window."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted window")
        out.append((unescape_role(m[1]), unescape(m[2]), m.start(2)))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted window")
    return out


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    Windows of a conversation must be together and in order, as chat_windows() gives them.
    """

    def task(batches):
        now = None

        def row():
            return now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5], now[6]

        for batch in batches:
            out = []
            for w in batch.to_pylist():
                if now is None or now[0] != w["conv_id"]:
                    if now is not None:
                        out.append(row())
                    now = [w["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                repeated = w["history_turns"] + w["has_system"]
                for role, text, _ in parse(w["formatted"])[repeated:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in w["loss_spans"]:
                    text = unescape(w["formatted"][span["begin"] : span["end"]])
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(w["formatted"])
                now[6] += 1
            yield _digests(out)
        yield _digests([row()] if now is not None else [])

    return windows.mapInArrow(frugal(task), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")


def _digests(rows: list[tuple]):
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"])
