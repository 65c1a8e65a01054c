"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in
order: texts are escaped, the others become a placeholder each, with a record of their reference,
their place in the formatted text and the number of tokens that the placeholder expands to. The
template marks every turn as ``<s>[ROLE]role[/ROLE]content</s>``; a conversation is the
concatenation of its turns. Control strings inside texts and roles are broken by a backslash after
their first character, and backslashes are doubled, so reading back is exact and no text can act
as a control. The loss mask covers the text parts of assistant turns.

Defined cases: null contents and null texts are empty, a null role is the empty role; a null
part is no part; a part of an unknown kind, or without the positive and finite sizes its count needs,
expands to one token; counts stop at 2^62; turns follow each other by
number, then role and text, nulls first; a null conv_id is a conversation of its own; an empty table
gives no rows; a conversation of any length is read back turn by turn, never as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The strings that steer the template, and some that steer models elsewhere.
CONTROLS = [
    "<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "[IMAGE]", "[AUDIO]", "[DOCUMENT]",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
]
PLACEHOLDERS = {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
_SPECIAL = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))
_MARKED = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.DOTALL)
_PLACE = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))

MOST_TOKENS = 1 << 62

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<kind: string, ref: string, start: int, tokens: long>"


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0] * 2 if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def _usable(size: float | None) -> bool:
    """Whether a size can be counted with: neither missing nor NaN, infinite, zero or negative."""
    return size is not None and math.isfinite(size) and size > 0


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text)


@dataclass
class Sizes:
    """What an attachment expands to: image patches with a break per row, audio frames, pages."""

    patch: int = 28
    frames_per_second: float = 12.5
    tokens_per_page: int = 512


class PartVisitor:
    """Flattens the parts of one turn; ``visit`` picks the method by the kind of a part."""

    def __init__(self, start: int, sizes: Sizes):
        self.text, self.at, self.sizes = [], start, sizes
        self.spans: list[tuple[int, int]] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_other)(part)

    def _add(self, text: str) -> None:
        self.text.append(text)
        self.at += len(text)

    def visit_text(self, part: dict) -> None:
        start = self.at
        self._add(escape(part["text"] or ""))
        if self.at > start:
            self.spans.append((start, self.at))

    def _attach(self, part: dict, tokens: int) -> None:
        tokens = min(tokens, MOST_TOKENS)
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "start": self.at, "tokens": tokens})
        self._add(PLACEHOLDERS.get(part["kind"], PLACEHOLDERS["document"]))

    def visit_image(self, part: dict) -> None:
        known = _usable(part["width"]) and _usable(part["height"])
        columns, rows = (-(-part[k] // self.sizes.patch) for k in ("width", "height")) if known else (0, 1)
        self._attach(part, columns * rows + rows)

    def visit_audio(self, part: dict) -> None:
        frames = part["seconds"] * self.sizes.frames_per_second if _usable(part["seconds"]) else 1
        self._attach(part, max(1, math.ceil(min(frames, MOST_TOKENS))))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, part["pages"] * self.sizes.tokens_per_page) if _usable(part["pages"]) else 1)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 1)


def format_turn(role: str | None, parts: list[dict] | None, sizes: Sizes = Sizes()) -> dict:
    """The formatted turn, the spans under the loss mask, and the attachments."""
    head = f"<s>[ROLE]{escape(role or '')}[/ROLE]"
    visitor = PartVisitor(len(head), sizes)
    for part in parts or []:
        if part is not None:
            visitor.visit(part)
    return {
        "formatted": "".join([head, *visitor.text, "</s>"]),
        "loss": visitor.spans if role == "assistant" else [],
        "attachments": visitor.attachments,
        "expanded_tokens": min(sum(a["tokens"] for a in visitor.attachments), MOST_TOKENS),
    }


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text, without the attachments' placeholders."""
    return [(unescape(r), unescape(_PLACE.sub("", t))) for r, t in _TURN.findall(formatted)]


FORMATTED = ["conv_id", "turn", "formatted", "loss", "attachments", "expanded_tokens"]


def _format(sizes: Sizes, id_type: str):
    loss = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    attached = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("start", pa.int32()), ("tokens", pa.int64())]))

    def run(batches):
        for batch in batches:
            rows = [format_turn(r, p, sizes) for r, p in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist())]
            spans = [[{"start": a, "stop": b} for a, b in r["loss"]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array([r["formatted"] for r in rows], pa.string()),
                    pa.array(spans, loss), pa.array([r["attachments"] for r in rows], attached),
                    pa.array([r["expanded_tokens"] for r in rows], pa.int64()),
                ],
                names=FORMATTED,
            )

    return run


def text_parts(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of plain messages with a column ``text``."""
    part = F.struct(F.lit("text").alias("kind"), F.col("text"), *[F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")])
    return messages.select("conv_id", "turn", "role", F.array(part.cast(PART)).alias("parts"))


def format_turns(messages: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Formatted turns of ``messages`` (conv_id, turn, role, parts); a map over the rows."""
    ids = {c: messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = (
        f"conv_id {ids['conv_id']}, turn {ids['turn']}, formatted string, loss array<struct<start: int, stop: int>>, "
        f"attachments array<{ATTACHMENT}>, expanded_tokens long"
    )
    return messages.select("conv_id", "turn", "role", "parts").mapInArrow(_format(sizes, ids["conv_id"]), schema)


class _Digest:
    """What is read back from the turns of one conversation, fed in order."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars, self.tokens = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: str, spans: list[dict], tokens: int) -> None:
        for role, text in read_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for span in spans:
            text = unescape(formatted[span["start"] : span["stop"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)
        self.tokens += tokens

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.tokens


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "expanded_tokens"]


def _digests(batches):
    current = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss", "expanded_tokens")]
        for conv_id, formatted, spans, tokens in zip(*columns):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv_id)
            current.feed(formatted, spans, tokens)
        yield _digest_rows(done, batch.schema.field("conv_id").type)
        kind = batch.schema.field("conv_id").type
    if current is not None:
        yield _digest_rows([current.row()], kind)


def _digest_rows(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=DIGEST)


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation, read from its formatted turns in order.

    The digests are sequential, so a conversation's turns stream through one task; nothing of it
    but the running digests is held.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    return (
        turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
        .select("conv_id", "formatted", "loss", "expanded_tokens")
        .mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                    "formatted_chars long, expanded_tokens long")
    )
