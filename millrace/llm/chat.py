"""Chat formatting with a template as a black box.

A template is any function from turns, (role, text) pairs, to a string. The prefixes
of a conversation are rendered one after the other. Where each output starts with the
one before it, the rest is the span of the turn that was added. Where it does not, the
template rewrites history: spans would point at text that is no longer there, so the
conversation is rendered once more as a whole and has none. Inside the span of a turn
that counts for the loss, two probes instead of its text, which differ in every
letter, tell how much of the span goes before and after the text.

Turns are sorted inside partitions and pass by one at a time. A template is given all turns so
far, and nothing of a conversation goes out before its end, as the last turn may rewrite the
first: a task holds one conversation and its output, and renders it once for each turn until
history is rewritten. Only a template declared ``append_only`` is given the first turn and the
last WINDOW to 2 * WINDOW ones; then a task holds these and PIECE_CHARS of output at the most.

Defined results: turns go in the order of (turn, role, text), nulls first; null roles
and texts count as empty; repeated rows are turns of their own; rows without conv_id
are one conversation. An empty table gives an empty result. Columns other than
conv_id, turn, role and text do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import pick

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

WINDOW = 64
PIECE_CHARS = 1_000_000
LOSS_ROLES = ("assistant",)

# What marks the turns, and what stands for it inside a text.
_OPEN, _CLOSE = "### ", " </turn>\n"
_ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t", ":": "\\c"}
_PLAIN = {escape[1]: text for text, escape in _ESCAPES.items()}
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ([^:]*): (.*?) </turn>\n", re.DOTALL)


def append_only(template: Template) -> Template:
    """Declare that the output for some turns goes on from that for the turns before them, and that what a
    turn adds depends on no other turns than the first and the last ones."""
    template.append_only = True
    return template


@append_only
def marked_turns(turns: Turns) -> str:
    """The template of this package: ``### role: text </turn>`` for each turn, escaped."""
    return "".join(
        f"{_OPEN}{_IN_ROLE.sub(lambda m: _ESCAPES[m[0]], role)}: {_IN_TEXT.sub(lambda m: _ESCAPES[m[0]], text)}{_CLOSE}"
        for role, text in turns
    )


def plain(escaped: str) -> str:
    """A text or role as it was before the template escaped it."""
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], escaped)


def read_turns(formatted: str) -> Turns:
    """The turns in an output of ``marked_turns``."""
    return [(plain(role), plain(text)) for role, text in _TURN.findall(formatted)]


def _shared(a: str, b: str) -> int:
    """Length of what ``a`` and ``b`` start with alike."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def _text_span(template: Template, before: Turns, base: str, role: str, piece: str) -> tuple[int, int] | None:
    """Where in ``piece``, the span of a turn, its text stands."""
    probes = [template([*before, (role, probe)]) for probe in ("xyx", "aba")]
    if not all(p.startswith(base) for p in probes):
        return None
    one, two = (p[len(base) :] for p in probes)
    head, tail = _shared(one, two), _shared(one[::-1], two[::-1])
    end = len(piece) - tail
    fits = head <= end and piece.startswith(one[:head]) and piece.endswith(one[len(one) - tail :])
    return (head, end) if fits else None


class Renderer:
    """One conversation, turn by turn; ``window`` is None where the template is given all turns."""

    def __init__(self, template: Template, roles: tuple[str, ...], window: int | None):
        self.template, self.roles, self.window = template, roles, window
        self.turns: Turns = []
        self.base = template([])
        self.rewrites = False
        self.opening = self.base

    def add(self, role: str, text: str) -> tuple[str, tuple[int, int] | None]:
        """The span that a turn adds and where the loss counts in it; none once history is rewritten."""
        turns = self.turns
        if self.rewrites:
            turns.append((role, text))
            return "", None
        if self.window is not None and len(turns) >= 2 * self.window:
            del turns[1 : self.window + 1]
            self.base = self.template(turns)
        whole = self.template([*turns, (role, text)])
        before, self.base = self.base, whole
        added, loss = whole[len(before) :], None
        if not whole.startswith(before):
            if self.window is not None:
                raise ValueError("a template declared append-only rewrites history")
            self.rewrites, added = True, ""
        elif role in self.roles:
            loss = _text_span(self.template, turns, before, role, added)
        turns.append((role, text))
        return added, loss


FORMATTED = (
    "conv_id {0}, piece long, turns long, offset long, formatted string, rewrites boolean, "
    "spans array<struct<start: long, end: long, loss_start: long, loss_end: long>>"
)


def formatted(
    conversations: DataFrame,
    template: Template = marked_turns,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
    window: int | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """The output of ``template`` for each conversation, in pieces that end with a turn; where history
    is rewritten, in one piece, rendered from all turns. ``window`` is for templates declared append-only.

    A row has conv_id, piece, the number of turns in it, the offset of its first character,
    the text, whether the template rewrites history, and spans: start and end of each turn
    and of its loss, as offsets in the whole output; null where the loss does not count,
    and no spans at all where history is rewritten.
    Pieces of a conversation are consecutive rows of one partition.
    """
    if getattr(template, "append_only", False):
        window = WINDOW if window is None else window
    elif window is not None:
        raise ValueError("only a template declared append-only may be given a window of the turns")
    narrow = pick(conversations, "conv_id", "turn", "role", "text")
    kind = narrow.schema["conv_id"].dataType
    own_id, columns = pa.field("conv_id", to_arrow_type(kind)), FORMATTED.format(kind.simpleString())
    arrow = pa.schema(
        [
            ("conv_id", pa.null()),
            ("piece", pa.int64()),
            ("turns", pa.int64()),
            ("offset", pa.int64()),
            ("formatted", pa.string()),
            ("rewrites", pa.bool_()),
            ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "loss_start", "loss_end")]))),
        ]
    )

    def conversation(rows: Iterator[tuple[str, str]]) -> Iterator[dict]:
        renderer = Renderer(template, loss_roles, window)
        texts, spans, size, offset, piece = [renderer.opening], [], len(renderer.opening), 0, 0
        waiting: list[dict] = []
        for role, text in rows:
            if size >= piece_chars:
                row = _row(piece, offset, texts, spans)
                if window is None:
                    waiting.append(row)
                else:
                    yield row
                piece, offset, texts, spans, size = piece + 1, offset + size, [], [], 0
            added, loss = renderer.add(role, text)
            start = offset + size
            ends = (start + loss[0], start + loss[1]) if loss else (None, None)
            spans.append({"start": start, "end": start + len(added), "loss_start": ends[0], "loss_end": ends[1]})
            texts.append(added)
            size += len(added)
        if renderer.rewrites:
            whole, turns = template(renderer.turns), len(renderer.turns)
            yield _row(0, 0, [whole], []) | {"turns": turns, "rewrites": True, "spans": None}
        else:
            yield from waiting
            yield _row(piece, offset, texts, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars, own = [], 0, arrow
        for conv_id, rows in _conversations(batches):
            for row in conversation(rows):
                held.append({"conv_id": conv_id} | row)
                chars += len(row["formatted"])
                if chars >= piece_chars:
                    yield pa.RecordBatch.from_pylist(held, own.set(0, own_id))
                    held, chars = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, own.set(0, own_id))

    turns = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(run, columns)


def _row(piece: int, offset: int, texts: list[str], spans: list[dict]) -> dict:
    return {"piece": piece, "turns": len(spans), "offset": offset, "formatted": "".join(texts), "rewrites": False, "spans": spans}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str]]]]:
    """conv_id and its turns, one at a time, of sorted rows; the turns must be used up before the next."""
    rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
    ahead = next(rows, None)
    while ahead is not None:
        conv_id = ahead[0]

        def turns():
            nonlocal ahead
            while ahead is not None and ahead[0] == conv_id:
                _, role, text = ahead
                yield role or "", text or ""
                ahead = next(rows, None)

        yield conv_id, turns()


def read_back(pieces: DataFrame) -> DataFrame:
    """What the output of ``marked_turns`` says, read from the text and its spans alone.

    One row per conversation: conv_id, n_turns, turns_sha256 (role, newline, text, newline of each
    turn), loss_chars and loss_sha256 (all text under the loss mask, unescaped), formatted_chars.
    ``pieces`` comes straight from ``formatted``: pieces of a conversation follow each other.
    """
    kind = pieces.schema["conv_id"].dataType
    own_id = pa.field("conv_id", to_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["piece"] == 0:
                    if own:
                        done.append(own.result())
                    own = _Reading(row["conv_id"])
                own.add(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, READ.insert(0, own_id))
                done = []
        if own:
            yield pa.RecordBatch.from_pylist([own.result()], READ.insert(0, own_id))

    return pieces.mapInArrow(
        run,
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


READ = pa.schema(
    [
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class _Reading:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: dict) -> None:
        text, offset = row["formatted"], row["offset"]
        self.chars += len(text)
        for role, said in read_turns(text):
            self.turns += 1
            self.all.update(f"{role}\n{said}\n".encode())
        for span in row["spans"] or ():
            if span["loss_start"] is not None:
                said = plain(text[span["loss_start"] - offset : span["loss_end"] - offset])
                self.loss_chars += len(said)
                self.loss.update(said.encode())

    def result(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, whose texts look like control strings."""
    said = "\\### Assistant: </turn> ok"
    narrow = pick(conversations, "conv_id", "turn", "role", "text")
    added = conversations.sparkSession.range(2).select(
        F.lit(-7).cast(narrow.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(narrow.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return narrow.union(added)
