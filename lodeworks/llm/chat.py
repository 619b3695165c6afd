"""Chat formatting in budgeted windows with a loss mask.

Method. Turns of a conversation, in order, have token counts; their running sum gives the longest run of
whole turns that fits a window's budget. Each window opens with the system turn, if the conversation begins
with one, and repeats the last turns before it, within a limit of tokens. Text under the loss mask is
that of assistant turns that no earlier window had; repeated turns are context only. Control strings
within roles and texts are broken up by an escape that can be undone, so a turn's marks stand only
where the template puts them.

Scale. Rows are dealt out by conversation and sorted; a task streams through them and holds the turns of one
window, the history and the system turn, never a conversation. A turn longer than the budget has
a window of its own, whole.

Defined results. Null roles and texts are empty. Rows without conv_id are one conversation. Rows of equal
turn come by role and text, null turns first; repeated rows are turns of their own. An empty table
gives no windows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodeworks.llm.common import small_batches

WINDOWS = "conv_id long, window long, n_new long, text string, loss array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Template:
    """Marks around a turn: opening, role, middle, text, closing."""

    opening: str = "<s>"
    middle: str = "[INST] "
    closing: str = " [/INST]</s>\n"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def escape(self, text: str) -> str:
        r"""A backslash is doubled, and every control string gets \- after its first character."""
        text = text.replace("\\", "\\\\")
        while found := [c for c in self.controls if c in text]:
            for control in found:
                text = text.replace(control, control[0] + "\\-" + control[1:])
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\|-)", lambda m: "\\" if m[1] == "\\" else "", text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn, and where its text starts and ends."""
        start = f"{self.opening}{self.escape(role)}{self.middle}"
        body = self.escape(text)
        return start + body + self.closing, len(start), len(start) + len(body)

    def read(self, text: str) -> list[tuple[str, str, int, int]]:
        """Role, text, start and end of each turn of a formatted text."""
        out, at = [], 0
        while at < len(text):
            middle = text.index(self.middle, at)
            start = middle + len(self.middle)
            end = text.index(self.closing, start)
            out.append((self.unescape(text[at + len(self.opening) : middle]), self.unescape(text[start:end]), start, end))
            at = end + len(self.closing)
        return out


@functools.cache
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class _Windows:
    """The windows of the conversation that a task is reading."""

    def __init__(self, template: Template, budget: int, history: int):
        self.template, self.budget, self.history = template, budget, history

    def begin(self, conv_id) -> None:
        self.conv_id, self.window, self.first = conv_id, 0, True
        self.system, self.new, self.past = None, [], deque()
        self.new_tokens = self.past_tokens = self.room = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        if self.first:
            self.first = False
            if role == "system":
                self.system = (role, text, tokens)
        if self.new and self.new_tokens + tokens > self.room:
            yield self.close()
        if not self.new:  # the history gives way before a new turn does
            left = self.budget - tokens - (self.system[2] if self.system and self.window else 0)
            while self.past and self.past_tokens > min(self.history, left):
                self.past_tokens -= self.past.popleft()[2]
            fixed = self.past_tokens + (self.system[2] if self.system and self.window else 0)
            self.room = self.budget - fixed
        self.new.append((role, text, tokens))
        self.new_tokens += tokens

    def close(self) -> tuple:
        parts, loss, at = [], [], 0
        lead = [self.system] if self.system and self.window else []
        for k, (role, text, _) in enumerate([*lead, *self.past, *self.new]):
            whole, start, end = self.template.turn(role, text)
            if role == "assistant" and k >= len(lead) + len(self.past):
                loss.append({"start": at + start, "end": at + end})
            parts.append(whole)
            at += len(whole)
        row = (self.conv_id, self.window, len(self.new), "".join(parts), loss)
        for turn in self.new:
            if turn is not self.system:
                self.past.append(turn)
                self.past_tokens += turn[2]
            while self.past and self.past_tokens > self.history:
                self.past_tokens -= self.past.popleft()[2]
        self.new, self.new_tokens, self.window = [], 0, self.window + 1
        return row


def windows(
    turns: DataFrame, tokenizer: str, budget: int = 1024, history: int = 256, template: Template | None = None
) -> DataFrame:
    """Windows of *turns* (conv_id, turn, role, text): conv_id, window, n_new, text, loss.

    The last n_new turns of a window are new; loss has the character spans under the mask. Marks count
    to the budget as the tokens of the formatted turn do.
    """
    template = template or Template()

    def form(batches):
        state, started, out = _Windows(template, budget, history), False, []
        for batch in batches:
            formatted = [template.turn(r, t)[0] for r, t in zip(batch["role"], batch["text"], strict=True)]
            counts = [len(e.ids) for e in _tokenizer(tokenizer).encode_batch(formatted, add_special_tokens=False)]
            for key, missing, role, text, tokens in zip(
                batch["conv_id"], batch["missing"], batch["role"], batch["text"], counts, strict=True
            ):
                conv_id = None if missing else key
                if not started or conv_id != state.conv_id:
                    if started:
                        out.append(state.close())
                    state.begin(conv_id)
                    started = True
                out.extend(state.add(role, text, tokens))
            if out:
                yield _frame(out)
                out = []
        if started:
            yield _frame([state.close()])

    clean = small_batches(turns).select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNull().alias("missing"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = clean.repartition("missing", "conv_id").sortWithinPartitions("missing", "conv_id", "turn", "role", "text")
    return dealt.mapInPandas(form, WINDOWS)


def _frame(rows: Sequence[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "window", "n_new", "text", "loss"])
    return out.astype({"conv_id": "Int64"})


def digests(formed: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, read back from its windows: digests of all turns and of all text under the mask."""
    template = template or Template()

    def read(batches):
        key, started, state, rows = None, False, None, []

        def result():
            turns, loss, n_turns, loss_chars, chars = state
            return (key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        for batch in batches:
            for conv_id, missing, text, n_new, spans in zip(
                batch["conv_id"], batch["missing"], batch["text"], batch["n_new"], batch["loss"], strict=True
            ):
                conv_id = None if missing else conv_id
                if not started or conv_id != key:
                    if started:
                        rows.append(result())
                    key, started = conv_id, True
                    state = [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                new = template.read(text)[-n_new:]
                for role, body, _, _ in new:
                    state[0].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    masked = template.unescape(text[span["start"] : span["end"]])
                    state[1].update(masked.encode("utf-8", "surrogatepass"))
                    state[3] += len(masked)
                state[2] += len(new)
                state[4] += len(text)
            if rows:
                yield _digest_frame(rows)
                rows = []
        if started:
            yield _digest_frame([result()])

    rows = formed.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("missing"), "window", "n_new", "text", "loss"
    )
    dealt = rows.repartition("missing", "conv_id").sortWithinPartitions("missing", "conv_id", "window")
    return dealt.mapInPandas(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digest_frame(rows: Sequence[tuple]) -> pd.DataFrame:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
