"""Chat formatting of turns with typed content parts.

A visitor walks the parts of each turn and writes text as it is (control strings escaped) and every image, audio clip
or document as an ordered placeholder, noting its reference and the tokens it expands to. Turns are formatted one row
at a time; a conversation is the concatenation of its turns' segments in order. Reading back streams sorted segments,
so no conversation is ever held whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches

START, END = "<|im_start|>", "<|im_end|>"
PARTS = "array<struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
ATTACHMENTS = "array<struct<placeholder: string, kind: string, ref: string, tokens: long>>"
#: Tokens that attachments expand to: one for each PATCH x PATCH pixels, AUDIO_RATE a second, PAGE_TOKENS a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256
SEGMENT = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """One backslash more between every < and | that only backslashes part, so that no control string is left."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


@dataclass
class Flatten:
    """Visitor over the parts of one turn; unknown kinds count as text. Missing measures count as the least size."""

    out: list[str] = field(default_factory=list)
    said: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    first: int = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.said.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        self._attach(part, math.ceil((part["width"] or 1) / PATCH) * math.ceil((part["height"] or 1) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0) * AUDIO_RATE) or 1)

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 1) * PAGE_TOKENS)

    def end_text(self) -> None:
        """Neighbouring texts are escaped together, so that no control string arises where they meet."""
        self.out.append(escape("".join(self.said)))
        self.said.clear()

    def _attach(self, part: dict, tokens: int) -> None:
        placeholder = f"<|{part['kind']}_{self.first + len(self.attachments)}|>"
        self.end_text()
        self.attachments.append({"placeholder": placeholder, "kind": part["kind"], "ref": part["ref"], "tokens": tokens})
        self.out.append(placeholder)


def format_turns(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, parts) -> (conv_id, turn, segment, loss_start, loss_end, attachments).

    loss_start and loss_end bound the characters of the segment under the loss mask: an assistant's content with the
    placeholders in it, else nothing. Null roles, parts and texts are empty. Placeholders are numbered from the turn's
    column `before` on (see numbered), without it from 0 in each turn. Repeated rows stay; other columns go. No shuffle."""
    before = F.coalesce(F.col("before"), F.lit(0)) if "before" in turns.columns else F.lit(0)
    rows = turns.select("conv_id", "turn", "role", F.col("parts").cast(PARTS).alias("parts"), before.cast("long").alias("before"))

    def run(batches):
        for batch in batches:
            segments, starts, ends, attached = [], [], [], []
            for role, parts, first in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                visitor = Flatten(first=first)
                for part in parts or ():
                    if part is not None:
                        visitor.visit(part)
                visitor.end_text()
                head, body = f"{START}{escape_role(role or '')}\n", "".join(visitor.out)
                segments.append(f"{head}{body}{END}\n")
                starts.append(len(head))
                ends.append(len(head) + (len(body) if role == "assistant" else 0))
                attached.append(visitor.attachments)
            kind = pa.list_(pa.struct([("placeholder", pa.string()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(segments, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(attached, kind)], ["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments"])

    kinds = dict(rows.dtypes)
    return map_batches(rows, run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, segment string, loss_start long, loss_end long, attachments {ATTACHMENTS}")


def numbered(turns: DataFrame) -> DataFrame:
    """turns with a column `before`: the attachments in earlier turns of the conversation, so that placeholders are numbered
    through it. Only turns with attachments are exchanged and ordered; equal turns of a conversation share their number."""
    attached = F.size(F.filter("parts", lambda p: F.coalesce(p["kind"].isin("image", "audio", "document"), F.lit(False))))
    counts = turns.select("conv_id", "turn", attached.alias("n")).filter("n > 0").groupBy("conv_id", "turn").agg(F.max("n").alias("n"))
    # a conversation's attachments up to a turn: (turn, n) of the turns that have any, which is at most its turns
    ordered = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("conv_id").orderBy("turn")))
    known = ordered.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), (F.col("upto") - F.col("n")).alias("before"))
    joined = turns.drop("before").join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")), "left")
    return joined.drop("_conv", "_turn")


def text_turns(conversations: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as turns of one text part each."""
    part = F.struct(F.lit("text").alias("kind"), F.col("text").alias("text"), *[F.lit(None).alias(x) for x in ("ref", "width", "height", "seconds", "pages")])
    return conversations.select("conv_id", "turn", "role", F.array(part).cast(PARTS).alias("parts"))


class _Digest:
    """What is read back from the segments of one conversation."""

    def __init__(self) -> None:
        self.n, self.loss_chars, self.chars, self.turns, self.loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, end: int) -> None:
        self.chars += len(segment)
        for role, text in SEGMENT.findall(segment):
            self.n += 1
            self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        masked = unescape(segment[start:end])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self, conv_id) -> tuple:
        return conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(segments: DataFrame) -> DataFrame:
    """One row for each conversation, parsed from the formatted output: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars.

    Segments are sorted by turn within conversations (equal turns by their text) and streamed; only hash states are
    kept, so a conversation of any length needs the same memory. Its hashes are sequential by definition, so its rows
    pass through one task. Null conv_ids are one conversation."""
    rows = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for conv_id, segment, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if state is None or conv_id != key:
                    if state is not None:
                        done.append(state.row(key))
                    key, state = conv_id, _Digest()
                state.add(segment, start, end)
            if done:
                yield _rows(done, batch.schema.field(0).type, names)
        if state is not None:
            yield _rows([state.row(key)], batch.schema.field(0).type, names)

    return map_batches(rows, run, f"conv_id {dict(rows.dtypes)['conv_id']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _rows(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
