"""Chat formatting in budgeted windows with a loss mask (operator 9).

Turns of a conversation are cut by the prefix sums of their tokens into
turn-aligned windows. Each window repeats the conversation's latest system turn
and a limited history, so that every turn is the target of exactly one window;
repeated turns are masked.

A conversation is read in order as a stream: its rows are sorted by
(conversation, turn) within a partition and a task holds the system turn, the
history within its budget and the open window, never a whole conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import python_batches

#: The template: a turn is ``### role: text </turn>`` and a line end.
START, MIDDLE, END = "### ", ": ", " </turn>\n"
#: Characters of the control strings; inside a text (and a role) they follow a backslash.
_CONTROL = re.compile(r"[\\#<]")
_ROLE_CONTROL = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: The text's group ends with the blank before the end mark.
_TURN = re.compile(r"### ((?:[^\\#<:]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.DOTALL)

WINDOW_SCHEMA = ("window_id long, formatted string, n_context int, n_turns int, n_tokens long, "
                 "loss_starts array<int>, loss_ends array<int>")


def escape(text: str, pattern: re.Pattern = _CONTROL) -> str:
    return pattern.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse_window(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window; raises if it is malformed."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"not a turn at {at}: {formatted[at:at + 40]!r}")
        out.append((unescape(m.group(1)), unescape(m.group(2)[:-1])))
        at = m.end()
    return out


def count_tokens(text: str) -> int:
    """Whitespace words and the template's three marks."""
    return len(text.split()) + 3


class _Conversation:
    """The open window of one conversation."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history_budget = budget, history
        self.system: tuple[str, str] | None = None
        self.prefix = 0                      # tokens of all turns so far
        self.past: deque = deque()           # (prefix before the turn, role, text) within the history budget
        self.open: list = []
        self.window_id = 0
        self.room = budget

    def _context(self) -> list[tuple[str, str]]:
        start = self.open[0][0]
        while self.past and start - self.past[0][0] > self.history_budget:
            self.past.popleft()
        out = [(r, t) for _, r, t in self.past]
        if self.system is not None and self.system not in out:
            out.insert(0, self.system)
        return out

    def add(self, role: str, text: str) -> dict | None:
        """Take the next turn; the window that it closes, if any."""
        n, done = count_tokens(text), None
        if self.open and self.prefix + n - self.open[0][0] > self.room:
            done = self.close()
        self.open.append((self.prefix, role, text))
        if len(self.open) == 1:
            self.context = self._context()
            self.room = self.budget - sum(count_tokens(t) for _, t in self.context)
        self.prefix += n
        return done

    def close(self) -> dict | None:
        if not self.open:
            return None
        parts, at, starts, ends, tokens = [], 0, [], [], 0
        for i, (role, text) in enumerate(self.context + [(r, t) for _, r, t in self.open]):
            head, body = START + escape(role, _ROLE_CONTROL) + MIDDLE, escape(text)
            if i >= len(self.context) and role == "assistant":
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts += [head, body, END]
            at += len(head) + len(body) + len(END)
            tokens += count_tokens(text)
        out = {"window_id": self.window_id, "formatted": "".join(parts), "n_context": len(self.context),
               "n_turns": len(self.open), "n_tokens": tokens, "loss_starts": starts, "loss_ends": ends}
        for x in self.open:
            if x[1] == "system":
                self.system = (x[1], x[2])
            self.past.append(x)
        while self.past and self.prefix - self.past[0][0] > self.history_budget:
            self.past.popleft()
        self.open, self.window_id = [], self.window_id + 1
        return out


def format_conversations(turns: DataFrame, budget: int = 512, history: int = 128,
                         conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Windows of every conversation: conv_id, window_id and the formatted text with its loss mask.

    A window holds the latest earlier system turn, up to ``history`` tokens of
    the turns before it (whole turns) and then new turns while all fit into
    ``budget`` tokens. The first ``n_context`` turns are repeated and masked;
    ``loss_starts`` and ``loss_ends`` are code point ranges of the new assistant
    texts, escaped as they stand. No turn is cut or dropped: a turn longer than
    the room left by its context has a window of its own, over budget.

    Null texts and roles count as empty. Turns go by ``turn`` (null first), ties
    by role and text; repeated rows are turns of their own. Rows of a null
    conversation form one conversation. An empty table gives no windows. Other
    columns are not read. Windows come out in order within a partition.
    """
    spark = turns.sparkSession
    python_batches(spark)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, conv, out, size = None, None, [], 0
        for batch in batches:
            ids = batch["conv_id"].astype("Int64").tolist() if len(batch) else []
            ids = [None if x is pd.NA else int(x) for x in ids]
            for c, role, text in zip(ids, batch["role"], batch["text"]):
                if now is None or c != conv:
                    last = now.close() if now is not None else None
                    if last:
                        out.append({"conv_id": conv, **last})
                    now, conv = _Conversation(budget, history), c
                done = now.add(role, text)
                if done:
                    out.append({"conv_id": conv, **done})
                    size += len(done["formatted"])
                if size > 8 << 20:
                    yield _frame(out)
                    out, size = [], 0
        last = now.close() if now is not None else None
        if last:
            out.append({"conv_id": conv, **last})
        if out:
            yield _frame(out)

    return rows.mapInPandas(windows, "conv_id long, " + WINDOW_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows)
    df["conv_id"] = df["conv_id"].astype("Int64")
    return df


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted windows.

    Takes ``format_conversations``' output as it comes (windows of a
    conversation in order, in one partition); keeps one running hash of the
    turns and one of the text under the loss mask.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_windows long")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = None, None
        for batch in batches:
            out = []
            for c, text, skip, starts, ends in zip(
                    batch["conv_id"].astype("Int64").tolist(), batch["formatted"], batch["n_context"],
                    batch["loss_starts"], batch["loss_ends"]):
                c = None if c is pd.NA else int(c)
                if state is None or c != conv:
                    if state is not None:
                        out.append(_row(conv, state))
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, body in parse_window(text)[skip:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for a, b in zip(starts, ends):
                    loss = unescape(text[a:b])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(text)
                state[5] += 1
            if out:
                yield _digest_frame(out)
        if state is not None:
            yield _digest_frame([_row(conv, state)])

    return windows.mapInPandas(digests, schema)


def _row(conv: int | None, s: list) -> tuple:
    return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5]


def _digest_frame(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                     "formatted_chars", "n_windows"])
    df["conv_id"] = df["conv_id"].astype("Int64")
    return df
