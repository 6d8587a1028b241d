"""Chat formatting of turns with typed content parts.

A visitor flattens the parts of a turn, in order: text is escaped, images, audio and documents
become placeholders, and an attachment records what each stands for and how many tokens
it expands to.  The result has one row per turn; a conversation's text is the concatenation of
its rows in the order of turns, so a conversation is never gathered in memory.

Template: ``<|im_start|>role\\n`` content ``<|im_end|>\\n``.  Within texts and roles a backslash is
doubled and ``<|`` becomes ``<\\|``, also where two parts meet, so control strings of the template
cannot occur in them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.llm.common import map_batches

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,"
    "pages:int>>"
)
# Tokens that attachments expand to: image patches, audio frames, page images.
PATCH = 28
FRAMES_PER_SECOND = 25
TOKENS_PER_PAGE = 256


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


class PartVisitor:
    """Column expressions for each type of part: what it shows as, and its expanded tokens."""

    types = ("text", "image", "audio", "document")

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)

    def image(self, part: Column) -> tuple[Column, Column]:
        across, down = F.ceil(part["width"] / PATCH), F.ceil(part["height"] / PATCH)
        return F.lit("<|image|>"), across * down

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), F.ceil(part["seconds"] * FRAMES_PER_SECOND)

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), part["pages"] * TOKENS_PER_PAGE

    def visit(self, part: Column) -> Column:
        """struct<type, ref, shown, tokens> of a part; unknown types show as nothing."""
        shown, tokens = F.lit(""), F.lit(0).cast("bigint")
        for name in self.types:
            own_shown, own_tokens = getattr(self, name)(part)
            is_it = part["type"] == name
            shown = F.when(is_it, own_shown).otherwise(shown)
            tokens = F.when(is_it, F.coalesce(own_tokens.cast("bigint"), F.lit(0))).otherwise(tokens)
        return F.struct(
            part["type"].alias("type"),
            part["ref"].alias("ref"),
            shown.alias("shown"),
            tokens.alias("tokens"),
        )


def text_parts(text: Column) -> Column:
    """The parts of a turn that is plain text."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part).cast(PARTS)


def _joined(text: Column, part: Column) -> Column:
    """A part after others; one that would complete a control string begins with a backslash."""
    meets = F.endswith(text, F.lit("<")) & F.startswith(part, F.lit("|"))
    return F.concat(text, F.when(meets, "\\").otherwise(""), part)


def format_turns(
    turns: DataFrame, parts: Column | None = None, visitor: PartVisitor | None = None
) -> DataFrame:
    """conv_id, turn, role, segment, loss_start, loss_end, attachments, expanded_tokens.

    ``turns`` has conv_id, turn, role and text, or ``parts`` names a column like
    :data:`PARTS`.  The loss mask covers [loss_start, loss_end) of an assistant's segment, in code
    points: its content without the template.  attachments list (place, type, ref, tokens) in
    order, place counting from 0 in the turn.  Null roles and texts count as empty; null
    part lists have no parts.
    """
    visitor = visitor or PartVisitor()
    parts = text_parts(F.col("text")) if parts is None else parts
    shown = F.coalesce(F.transform(parts, visitor.visit), F.array())
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), shown.alias("shown"))
    content = F.aggregate("shown", F.lit(""), lambda text, p: _joined(text, p["shown"]))
    opening = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    attached = F.filter("shown", lambda p: p["type"].isin("image", "audio", "document"))
    is_loss = F.col("role") == ASSISTANT
    return rows.withColumns({"content": content, "opening": opening}).select(
        "conv_id",
        "turn",
        "role",
        F.concat("opening", "content", F.lit(END)).alias("segment"),
        F.when(is_loss, F.char_length("opening")).alias("loss_start"),
        F.when(is_loss, F.char_length("opening") + F.char_length("content")).alias("loss_end"),
        F.transform(
            attached,
            lambda p, i: F.struct(i.alias("place"), p["type"], p["ref"], p["tokens"]),
        ).alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, p: n + p["tokens"]).alias(
            "expanded_tokens"
        ),
    )


_ESCAPED = re.compile(r"\\(.)", re.S)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document)\|>")
_SEGMENT = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)


def unescape(text: str) -> str:
    """The text parts of escaped content; placeholders are left out."""
    return _ESCAPED.sub(r"\1", _PLACEHOLDER.sub("", text))


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


_READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


class _Conversation:
    """Running digests of the conversation that is being read."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        match = _SEGMENT.fullmatch(segment)
        if match is None:
            raise ValueError(f"not a formatted turn: {segment[:80]!r}")
        role, content = unescape_role(match[1]), unescape(match[2])
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{content}\n".encode())
        if start is not None:
            learned = unescape(segment[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def read_back(segments: DataFrame) -> DataFrame:
    """Parse formatted turns again: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars of each conversation.

    Turns stream through in order; memory holds one batch and the digests of one
    conversation, however long it is.  Turns with equal numbers are read in the order
    of their segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for x in batches:
            for conv, segment, start, end in zip(
                *(x.column(i).to_pylist() for i in range(4)), strict=True
            ):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(conv)
                current.add(segment, start, end)
            if len(done) >= 10_000:
                yield _read_rows(done)
                done = []
        if current is not None:
            done.append(current.row())
        if done:
            yield _read_rows(done)

    ordered = (
        segments.select("conv_id", "turn", "segment", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
        .select(F.col("conv_id").cast("bigint"), "segment", "loss_start", "loss_end")
    )
    return map_batches(ordered, run, _READ)


def _read_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in _READ.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def probe_turns(spark: SparkSession) -> DataFrame:
    """A conversation whose texts hold control strings of the template."""
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", text), (-1, 1, ASSISTANT, text)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
