"""Conversations as training windows within a token budget, with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm import bpe
from roomledger.operators.lookup import Dimension, lookup
from roomledger.session import work_folder

# A turn is START, role, line feed, text, END. The others are control strings too.
START, END = "<s>", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
SYSTEM, ASSISTANT = "system", "assistant"

# A control string after its first character, which any number of backslashes may follow.
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE = re.compile(rf"(?<=[<\[])(?=\\*(?:{_TAILS}))")
_UNESCAPE = re.compile(rf"(?<=[<\[])\\(?=\\*(?:{_TAILS}))")

# Turn numbers that one task formats; a longer conversation is dealt over several.
SEGMENT = 512
NO_SEGMENT = -(1 << 62)

# Characters of windows that leave a task at once.
OUT = 1 << 22

WINDOWS = (
    "conv_id bigint, segment bigint, window int, text string, n_tokens bigint, n_turns int, "
    "repeated int, loss array<struct<start:bigint, end:bigint>>"
)
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def escaped(text: str) -> str:
    """The text without control strings: each gets a backslash after its first character."""
    return _ESCAPE.sub(r"\\", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub("", text)


def role_escaped(role: str) -> str:
    """A role in one line."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_unescaped(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role), flags=re.DOTALL)


@dataclass
class Turn:
    """A formatted turn: where its text lies in it and what it costs."""

    body: str
    head: int
    tokens: int
    is_target: bool


@dataclass
class Spans:
    """Cuts the turns of a segment into windows as they come; holds one window and its history.

    before counts the tokens of all turns up to now, so a span's cost is a difference.
    """

    budget: int
    history_turns: int
    history_tokens: int
    system: Turn | None = None
    opening: Turn | None = None
    window: int = 0
    before: int = 0
    start: int = 0
    head: int = 0
    own: list[Turn] = field(default_factory=list)
    repeated: list[Turn] = field(default_factory=list)
    past: deque[Turn] = field(default_factory=deque)

    def retain(self, turn: Turn) -> None:
        """The system turn, for all windows from now on, if it leaves them half the budget."""
        self.system = turn if turn.tokens <= self.budget // 2 else None

    def remember(self, turn: Turn) -> None:
        """A turn that later windows may repeat."""
        self.past.append(turn)
        while len(self.past) > self.history_turns or self._past_tokens() > self.history_tokens:
            self.past.popleft()

    def _past_tokens(self) -> int:
        return sum(t.tokens for t in self.past)

    def add(self, turn: Turn) -> Iterator[tuple]:
        """Takes the turn; gives the window that it no longer fits in, if it ends one."""
        if self.own and self.head + self.before - self.start + turn.tokens > self.budget:
            yield self.closed()
        if not self.own:
            # History gives way, oldest turn first, where the turn would not fit beside it.
            fixed = self.system.tokens if self.system else 0
            while self.past and fixed + self._past_tokens() + turn.tokens > self.budget:
                self.past.popleft()
            self.repeated = [*([self.system] if self.system else []), *self.past]
            self.head = fixed + self._past_tokens()
            self.start = self.before
        self.own.append(turn)
        self.before += turn.tokens

    def closed(self) -> tuple:
        """The window so far, whose turns are history from now on."""
        loss, at = [], sum(len(t.body) for t in self.repeated)
        for turn in self.own:
            if turn.is_target:
                loss.append({"start": at + turn.head, "end": at + len(turn.body) - len(END)})
            at += len(turn.body)
        turns = [*self.repeated, *self.own]
        text = "".join(t.body for t in turns)
        size = self.head + self.before - self.start
        row = (self.window, text, size, len(turns), len(self.repeated), loss)
        for turn in self.own:
            self.retain(turn) if turn is self.opening else self.remember(turn)
        self.own, self.window = [], self.window + 1
        return row


def formatted_turn(enc, role: str | None, text: str | None) -> Turn:
    head = f"{START}{role_escaped(role or '')}\n"
    body = f"{head}{escaped(text or '')}{END}"
    return Turn(body, len(head), len(bpe.encode(enc, body)), role == ASSISTANT)


def turns_of(window: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window's text."""
    heads = (body[len(START) :].partition("\n") for body in window.split(END)[:-1])
    return [(role_unescaped(role), unescaped(text)) for role, _, text in heads]


def _segments(turns: DataFrame, history_turns: int, folder: str) -> DataFrame:
    """Turns by segment. _kind: 0 the conversation's first turn, 1 one of those just before the
    segment, 2 one of the segment. A conversation's first segment has turns of its own only.
    """
    by_number = F.floor(F.col("turn") / SEGMENT).cast("bigint")
    own = turns.withColumn("segment", F.coalesce(by_number, F.lit(NO_SEGMENT)))
    here = F.struct(F.col("segment"), F.lit(2).alias("_kind"))
    next_ = F.struct((F.col("segment") + 1).alias("segment"), F.lit(1).alias("_kind"))
    is_last = F.coalesce(F.pmod("turn", F.lit(SEGMENT)) >= SEGMENT - history_turns, F.lit(False))
    places = F.when(is_last, F.array(here, next_)).otherwise(F.array(here))
    placed = own.select("conv_id", "turn", "role", "text", F.inline(places))

    # Conversations over several segments; their segments but the first get the first turn.
    reach = own.groupBy("conv_id").agg(F.min("segment").alias("_first"), F.max("segment").alias("_last"))
    long = reach.filter("_first < _last").select(F.col("conv_id").alias("_conv"), "_first")
    long.write.parquet(f"{folder}/long")
    dimension = Dimension.counted(turns.sparkSession.read.parquet(f"{folder}/long"))
    within = lookup(own, dimension, F.col("conv_id").eqNullSafe(F.col("_conv")))
    opening = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "text")
    heads = within.filter("segment = _first").groupBy("conv_id").agg(F.min(opening).alias("_head"))
    later = within.filter("segment > _first").select(F.col("conv_id").alias("_conv"), "segment").distinct()
    first = later.join(heads, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "_head.turn", "_head.role", "_head.text", "segment", F.lit(0).alias("_kind")
    )
    return placed.unionByName(first)


def chat_windows(
    conversations: DataFrame,
    rank_file: str,
    pattern: str,
    budget: int = 2048,
    history_turns: int = 2,
    history_tokens: int = 512,
) -> DataFrame:
    """One row per window: conv_id, segment, window, text, n_tokens, n_turns, repeated, loss.

    A window is a run of whole turns within budget tokens, after the conversation's system turn
    and up to history_turns turns before the run (history_tokens at most); these two come
    first and repeat earlier ones, `repeated` of them. loss has the code-point spans of the
    assistant texts of the run, without marks: a repeated one is masked, so each is learnt
    once. A turn that does not fit alone has a window of its own beyond the budget, after the
    system turn; texts are never cut.

    The system turn is a first turn with that role; if it takes more than half the budget, later
    windows do without. Control strings in texts and roles get a backslash, which
    turns_of takes back. Turns ascend by turn, role and text, NULL first; NULL role or text
    is empty. Repeated rows are turns of their own, rows without conv_id one conversation.
    An empty table gives no rows. Other columns are not read.

    Rows are dealt by conversation and SEGMENT turn numbers, so a long conversation is formatted by
    many tasks: a segment starts a window, with the system turn and the turns of the last
    numbers before it. A task holds one window, not a conversation.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoding(rank_file, pattern)
        key, rows, size = None, [], 0
        spans = Spans(budget, history_turns, history_tokens)
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["conv_id"], row["segment"])
                done = []
                if own != key:
                    done += [(key, spans.closed())] if spans.own else []
                    key, spans = own, Spans(budget, history_turns, history_tokens)
                    opens = row["_kind"] == 2
                turn = formatted_turn(enc, row["role"], row["text"])
                if row["_kind"] == 0:
                    if row["role"] == SYSTEM:
                        spans.retain(turn)
                elif row["_kind"] == 1:
                    spans.remember(turn)
                else:
                    if opens and row["role"] == SYSTEM:
                        spans.opening = turn
                    opens = False
                    done += [(key, window) for window in spans.add(turn)]
                for where, window in done:
                    rows.append((*where, *window))
                    size += len(window[1])
                if size > OUT:
                    yield _out(rows)
                    rows, size = [], 0
        if spans.own:
            rows.append((*key, *spans.closed()))
        if rows:
            yield _out(rows)

    dealt = _segments(turns, history_turns, work_folder(turns.sparkSession, "chat"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "segment", "_kind", "turn", "role", "text")]
    return dealt.repartition("conv_id", "segment").sortWithinPartitions(*order).mapInArrow(run, WINDOWS)


def _out(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {
        "conv_id": pa.int64(), "segment": pa.int64(), "window": pa.int32(), "text": pa.string(),
        "n_tokens": pa.int64(), "n_turns": pa.int32(), "repeated": pa.int32(), "loss": span,
    }
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())]
    return pa.record_batch(columns, names=list(kinds))


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows say: one row per conversation with digests of its turns and targets.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each turn),
    loss_chars, loss_sha256 (all text under the loss mask, unescaped), formatted_chars. A
    conversation's windows pass through one task in order, one at a time: a digest has no parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, rows = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != key:
                    rows += [] if now is None else [(key, *now.row())]
                    key, now = row["conv_id"], _Digests()
                now.take(row)
            if len(rows) > 4096:
                yield _digest_rows(rows)
                rows = []
        if now is not None:
            yield _digest_rows([*rows, (key, *now.row())])

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "segment", "window")]
    own = windows.select("conv_id", "segment", "window", "text", "repeated", "loss")
    return own.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, DIGESTS)


class _Digests:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def take(self, row: dict) -> None:
        for role, text in turns_of(row["text"])[row["repeated"] :]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in row["loss"]:
            learnt = unescaped(row["text"][span["start"] : span["end"]])
            self.loss.update(learnt.encode())
            self.loss_chars += len(learnt)
        self.formatted_chars += len(row["text"])

    def row(self) -> tuple:
        return (
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars,
        )


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
