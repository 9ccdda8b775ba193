"""Chat formatting: a finite-state machine over roles emits text segments with loss flags.

Rows of a conversation meet in one partition, sorted by turn, and stream through the
machine: only the state and the current turn are in memory, however long a conversation is.
Texts are escaped, so no text can forge a control string, and the output can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, segment int, turn int, part string, text string, loss boolean, error string"


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the roles that bear loss, and the turn order as a state machine.

    ``moves[state][role]`` is the next state; a conversation may end in a state of ``ends``.
    """

    start: str = "<|turn|>"
    middle: str = "\n"
    end: str = "<|end|>\n"
    control: str = "<|"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    first: str = "start"
    ends: tuple[str, ...] = ("answered",)
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )

    def guard(self, text: str) -> str:
        """Text without any control string; ``reveal`` undoes it."""
        e = self.escape
        return text.replace(e, e + e).replace(self.control, e + self.control)

    def reveal(self, text: str) -> str:
        e = re.escape(self.escape)
        return re.sub(f"{e}({e}|{re.escape(self.control)})", r"\1", text)

    def header(self, role: str) -> str:
        """Start of a turn; a line break inside a role is escaped like a control string."""
        return self.start + self.guard(role).replace("\n", self.escape + "n") + self.middle

    def role_of(self, header: str) -> str:
        body = header[len(self.start) : len(header) - len(self.middle)]
        e = re.escape(self.escape)
        return re.sub(
            f"{e}({e}|n|{re.escape(self.control)})",
            lambda m: "\n" if m[1] == "n" else m[1],
            body,
        )


def format_chats(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, segment, turn, part, text, loss, error): the segments of every conversation in order.

    Needs conv_id, turn, role, text; other columns are ignored. ``part`` is head, body or
    tail. ``error`` names the first breach of the turn order on the segment where it shows,
    and an unfinished conversation on its last tail; such conversations are formatted all
    the same. Null texts and roles are empty, a null conv_id is one conversation of its own,
    null turns come first, equal turns go by role, then text. An empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nothing = object()
        conv, state, segment, turn, bad = nothing, template.first, 0, 0, False
        held: list | None = None  # the last tail, until the end of its conversation is known

        for batch in batches:
            out: list[tuple] = []
            for c, role, text in zip(batch["conv_key"], batch["role"], batch["text"], strict=True):
                if c != conv:
                    if held:
                        held[6] = held[6] or (None if bad or state in template.ends else "unfinished")
                        out.append(tuple(held))
                    conv, state, segment, turn, bad, held = c, template.first, 0, 0, False, None
                if held:
                    out.append(tuple(held))
                after = template.moves.get(state, {}).get(role)
                error = None
                if after is None and not bad:
                    error, bad = f"{role!r} after {state}", True
                state = after or state
                key = None if c == "" else int(c)
                out.append((key, segment, turn, "head", template.header(role), False, error))
                loss = role in template.loss_roles
                out.append((key, segment + 1, turn, "body", template.guard(text), loss, None))
                held = [key, segment + 2, turn, "tail", template.end, False, None]
                segment, turn = segment + 3, turn + 1
            yield _frame(out)
        if held:
            held[6] = None if bad or state in template.ends else "unfinished"
            yield _frame([tuple(held)])

    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv_key"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        rows.repartition("conv_key")
        .sortWithinPartitions("conv_key", "turn", "role", "text")
        .mapInPandas(run, SEGMENTS)
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(
        rows, columns=["conv_id", "segment", "turn", "part", "text", "loss", "error"]
    )
    return out.astype({"conv_id": "Int64"})


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the segments as ``format_chats`` streams them.

    Counts turns, hashes roles and texts, and hashes what lies under the loss mask, all
    unescaped again. Segments are read in their partitions' order, without a shuffle.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, valid boolean"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None

        def row() -> tuple:
            return (now["id"], now["n"], now["turns"].hexdigest(), now["loss_chars"],
                    now["loss"].hexdigest(), now["chars"], now["valid"])

        for batch in batches:
            out = []
            for c, segment, part, text, loss, error in zip(
                *(batch[k] for k in ("conv_id", "segment", "part", "text", "loss", "error")),
                strict=True,
            ):
                if segment == 0:
                    if now:
                        out.append(row())
                    now = {"id": None if pd.isna(c) else int(c), "n": 0, "chars": 0, "valid": True,
                           "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0}
                now["chars"] += len(text)
                now["valid"] &= not error
                if part == "head":
                    now["n"] += 1
                    now["turns"].update((template.role_of(text) + "\n").encode())
                elif part == "body":
                    plain = template.reveal(text)
                    now["turns"].update((plain + "\n").encode())
                    if loss:
                        now["loss_chars"] += len(plain)
                        now["loss"].update(plain.encode())
            yield _summary(out)
        if now:
            yield _summary([row()])

    def _summary(rows: list[tuple]) -> pd.DataFrame:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars", "valid"]
        return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    return segments.mapInPandas(run, schema)
