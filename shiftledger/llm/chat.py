"""Chat formatting with typed content parts.

A message holds text, image, audio and document parts. A visitor flattens them, in
order, into one string with a placeholder per attachment, and records the attachments
and how many tokens each part expands to. The template marks turns with
control strings; control strings inside texts are broken up by a backslash (and backslashes doubled),
so the formatted text can be read back exactly.

Each turn is formatted by itself, one row in and one row out; a conversation is the
concatenation of its turns in order. Reading back sorts the turns of a conversation inside
Spark's partitions and hashes them as a stream, so memory does not grow with the
length of a conversation.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings, ours first and then those of common chat templates.
TURN, SAYS, OVER = "<|turn|>", "<|says|>", "<|over|>"
IMAGE, AUDIO, DOCUMENT = "<|image|>", "<|audio|>", "<|document|>"
CONTROLS = (TURN, SAYS, OVER, IMAGE, AUDIO, DOCUMENT, "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>")
LEARNED_ROLE = "assistant"
PARTS = (
    "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
)
FORMATTED = (
    "conv_id long, turn long, role string, text string, formatted string, loss_start int, loss_end int, n_tokens long,"
    " attachments array<struct<kind: string, ref: string, place: int, tokens: int>>"
)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROLS:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Sizes:
    """How many tokens an attachment expands to."""

    patch: int = 28  # pixels on a side of an image patch
    audio_rate: float = 12.5  # tokens per second
    page: int = 256  # tokens per page of a document


@dataclass
class Flattener:
    """Visits the parts of one message in order; what it has gathered is read afterwards."""

    sizes: Sizes = field(default_factory=Sizes)
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0
    place: int = 0

    def visit(self, part: dict) -> None:
        """Unknown types and parts without a type count as text."""
        visitor = getattr(self, f"visit_{part.get('type') or 'text'}", None)
        (visitor or self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.tokens += sum(1 for _ in _WORD.finditer(text))
        self._put(escape(text))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part.get(x) or 0) / self.sizes.patch) for x in ("width", "height"))
        self._attach("image", IMAGE, part, max(across * down, 1))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", AUDIO, part, max(math.ceil((part.get("seconds") or 0) * self.sizes.audio_rate), 1))

    def visit_document(self, part: dict) -> None:
        self._attach("document", DOCUMENT, part, max(part.get("pages") or 0, 1) * self.sizes.page)

    def _attach(self, kind: str, placeholder: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "place": self.place, "tokens": tokens})
        self.tokens += tokens
        self._put(placeholder)

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.place += len(piece)


def format_turn(role: str | None, parts: list[dict], sizes: Sizes | None = None) -> dict:
    """One turn: its formatted text, the span under the loss mask, tokens and attachments (places in the formatted text)."""
    head = TURN + escape(role or "") + SAYS
    visitor = Flattener(sizes or Sizes(), place=len(head))
    for part in parts:
        visitor.visit(part)
    body = "".join(visitor.pieces)
    learned = (len(head), len(head) + len(body)) if role == LEARNED_ROLE else (0, 0)
    return {
        "formatted": head + body + OVER, "loss_start": learned[0], "loss_end": learned[1], "n_tokens": visitor.tokens,
        "attachments": visitor.attachments,
    }


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders of attachments stay in the text."""
    if not formatted.startswith(TURN) or not formatted.endswith(OVER):
        raise ValueError("not a formatted turn")
    head, says, body = formatted[len(TURN) : -len(OVER)].partition(SAYS)
    if not says:
        raise ValueError("not a formatted turn")
    return unescape(head), unescape(body)


def _formatted_rows(batches: Iterator[pa.RecordBatch], sizes: Sizes | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            parts = [{"type": "text", "text": row["text"]}] if row["parts"] is None else [p or {} for p in row["parts"]]
            del row["parts"]
            made.append(row | format_turn(row["role"], parts, sizes))
        yield pa.RecordBatch.from_pylist(made, schema=schema)


def format_turns(messages: DataFrame, *, sizes: Sizes | None = None) -> DataFrame:
    """One row per message: conv_id, turn, role, text, formatted, loss_start, loss_end, n_tokens, attachments.

    ``messages`` has conv_id, turn, role and text, or (where it is not null) the column ``parts``
    of the type ``PARTS``. Null texts count as empty, null roles as the empty role; rows without a
    conversation form the conversation null. Repeated rows are repeated turns. An empty table gives no
    rows. Other columns are left out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    parts = messages["parts"].cast(PARTS) if "parts" in messages.columns else F.lit(None).cast(PARTS)
    rows = messages.select(
        messages["conv_id"].cast("long").alias("conv_id"), messages["turn"].cast("long").alias("turn"),
        messages["role"].cast("string").alias("role"),
        (messages["text"] if "text" in messages.columns else F.lit(None)).cast("string").alias("text"), parts.alias("parts"),
    )
    schema = to_arrow_schema(StructType.fromDDL(FORMATTED))
    return rows.mapInArrow(lambda b: _formatted_rows(b, sizes, schema), FORMATTED)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose turns come one after the other."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, state, done = None, None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def close() -> None:
        turns, digest, chars, loss, formatted = state
        done.append((now, turns, digest.hexdigest(), chars, loss.hexdigest(), formatted))

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end"))
        for conv, formatted, start, end in zip(*columns, strict=True):
            if state is None or conv != now:
                if state is not None:
                    close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(formatted)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            learned = unescape(formatted[start:end])
            state[2] += len(learned)
            state[3].update(learned.encode())
            state[4] += len(formatted)
        if len(done) >= 10_000:
            yield batch_of(done)
            done = []
    if state is not None:
        close()
    if done:
        yield batch_of(done)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from formatted turns: n_turns, digests and lengths.

    Turns are ordered by turn (null first), and equal turns by their formatted text.
    """
    rows = formatted.select("conv_id", "turn", "formatted", "loss_start", "loss_end")
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "formatted"
    )
    return ordered.drop("turn").mapInArrow(
        _read_rows,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
