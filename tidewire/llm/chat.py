"""Chat formatting into budgeted windows of whole turns, with a loss mask.

The prefix sums of a conversation's turn tokens choose spans of turns that fit a budget. Every window
starts with the conversation's system turn, repeats a limited history of the turns before its span and
then holds the span. The mask covers the assistant texts of the span; repeated ones are not trained on
again, so every assistant text is under the mask exactly once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import slices, worker_cache
from tidewire.llm.encoders import TokenCounter


@dataclass(frozen=True)
class Template:
    """Marks of a turn. `controls` are strings that texts may not hold as they are.

    A text's control string gets a backslash after its first character, one more if it has some
    already, so that escaping can be undone.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "[INST]",
        "[/INST]", "<<SYS>>", "<</SYS>>",
    )

    def escape(self, text: str) -> str:
        return self._pattern("").sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self._pattern(r"\\").sub(r"\1\2", text)

    def _pattern(self, escaped: str) -> regex.Pattern:
        first = "".join(sorted({regex.escape(c[0]) for c in self.controls}))
        rest = "|".join(regex.escape(c[1:]) for c in self.controls)
        return regex.compile(rf"([{first}]){escaped}(\\*)(?={rest})")

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """A formatted turn and where its text lies in it."""
        one_line = role.replace("\\", "\\\\").replace("\n", "\\n")
        head = f"{self.start}{self.escape(one_line)}\n"
        body = self.escape(text)
        return f"{head}{body}{self.end}\n", len(head), len(head) + len(body)

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """role and text of every turn of a formatted window."""
        for part in formatted.split(self.start)[1:]:
            role, body = part.removesuffix(f"{self.end}\n").split("\n", 1)
            role = regex.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(role))
            yield role, self.unescape(body)


@dataclass(frozen=True)
class ChatConfig:
    """Tokens per window, and how many turns and tokens of history are repeated at most."""

    budget: int = 1024
    history_turns: int = 2
    history_tokens: int = 256
    template: Template = field(default_factory=Template)
    path: str = public_tokenizers.path("byte_bpe_50k.json")


DEFAULT = ChatConfig()
SCHEMA = (
    "conv_id bigint, window bigint, n_context bigint, first_turn bigint, n_turns bigint, n_tokens bigint, "
    "over_budget boolean, formatted string, mask array<struct<start: bigint, end: bigint>>"
)
NAMES = [
    "conv_id", "window", "n_context", "first_turn", "n_turns", "n_tokens", "over_budget", "formatted", "mask",
]


@dataclass
class Turn:
    role: str
    formatted: str
    start: int
    end: int
    tokens: int


class Windows:
    """The windows of one conversation, made turn by turn; holds one window and the history."""

    def __init__(self, conv_id: int | None, config: ChatConfig):
        self.conv_id, self.config = conv_id, config
        self.system: Turn | None = None
        self.before: list[Turn] = []
        self.span: list[Turn] = []
        self.seen = self.window = self.prefix = self.span_from = 0

    def context(self) -> list[Turn]:
        """The system turn and as much of the latest history as the limits allow."""
        history, tokens = [], 0
        for turn in reversed(self.before):
            if turn is self.system or tokens + turn.tokens > self.config.history_tokens:
                break
            history.insert(0, turn)
            tokens += turn.tokens
        return ([self.system] if self.system and self.window else []) + history

    def add(self, turn: Turn) -> tuple | None:
        """Take a turn; gives the finished window if the turn does not fit into it any more."""
        done = None
        spent = sum(t.tokens for t in self.context())
        if self.span and spent + self.prefix - self.span_from + turn.tokens > self.config.budget:
            done = self.finish()
        if not self.seen and turn.role == "system":
            self.system = turn
        self.span.append(turn)
        self.prefix += turn.tokens
        self.seen += 1
        return done

    def finish(self) -> tuple:
        context = self.context()
        fresh = self.prefix - self.span_from
        if len(self.span) == 1 and fresh + sum(t.tokens for t in context) > self.config.budget:
            context = context[:1] if self.system and self.window else []
        at, mask, text = 0, [], []
        for i, turn in enumerate(context + self.span):
            if i >= len(context) and turn.role == "assistant":
                mask.append({"start": at + turn.start, "end": at + turn.end})
            at += len(turn.formatted)
            text.append(turn.formatted)
        total = fresh + sum(t.tokens for t in context)
        row = (
            self.conv_id, self.window, len(context), self.seen - len(self.span), len(self.span), total,
            total > self.config.budget, "".join(text), mask,
        )
        keep = self.config.history_turns
        self.before = (self.before + self.span)[-keep:] if keep else []
        self.span, self.span_from, self.window = [], self.prefix, self.window + 1
        return row


def windows(turns: DataFrame, config: ChatConfig = DEFAULT) -> DataFrame:
    """The formatted windows of all conversations; rows of a conversation are adjacent and in order.

    `turns` has conv_id, turn, role, text; turns are ordered by turn, then role and text, and repeated
    rows are turns of their own. NULL roles and texts count as empty, NULL turns come first, rows
    without conv_id are one conversation. A turn that alone exceeds the budget gets a window of its
    own, marked `over_budget`; nothing is cut. Conversations are streamed in turn order: a task holds
    one window and its history, however long a conversation is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(f"counter {config.path}", lambda: TokenCounter(config.path))
        now: Windows | None = None
        for batch in slices(batches):
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        rows.append(now.finish())
                    now = Windows(conv, config)
                formatted, start, end = config.template.turn(role or "", text or "")
                done = now.add(Turn(role or "", formatted, start, end, counter.count(formatted)))
                if done:
                    rows.append(done)
            yield to_batch(rows)
        if now is not None:
            yield to_batch([now.finish()])

    ordered = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"),
        F.col("text").cast("string"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, SCHEMA)


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.string(), pa.list_(span)]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def digests(formatted: DataFrame, config: ChatConfig = DEFAULT) -> DataFrame:
    """What can be read back from the windows of each conversation, in the order `windows` gives them.

    conv_id, n_turns, turns_sha256 over role and text of every turn, loss_chars and loss_sha256 of the
    texts under the mask, formatted_chars. Context turns are skipped, as earlier windows hold them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in slices(batches):
            rows = []
            for row in batch.select(["conv_id", "n_context", "formatted", "mask"]).to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        rows.append(close(conv, state))
                    conv, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for i, (role, text) in enumerate(config.template.parse(row["formatted"])):
                    if i >= row["n_context"]:
                        state[0] += 1
                        state[1].update(f"{role}\n{text}\n".encode())
                for span in row["mask"]:
                    text = config.template.unescape(row["formatted"][span["start"] : span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(row["formatted"])
            yield to_rows(rows)
        if state is not None:
            yield to_rows([close(conv, state)])

    def close(conv: int | None, state: list) -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    def to_rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return formatted.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
