"""Operator 8: chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document).  A visitor flattens them in order: text is escaped, and
every other part becomes a numbered placeholder, an attachment reference and an expanded token count.  The template's
control strings all begin with ``[`` or ``<``; in texts these characters (and the escape itself) get a backslash before them, so a text can
hold any control string and is read back exactly.

    user [INST]..[/INST]   assistant <s>..</s>   system <<SYS>>..<</SYS>>   others [ROLE]name[TEXT]..[/ROLE]

``format_turns`` works row by row: one piece of the formatted conversation for each turn, with the range under the
loss mask; the conversation is the pieces in order.  ``read_back`` streams the sorted pieces and keeps only
running digests, so a conversation with a third of all rows needs no more memory than its longest turn.

Defined results: null text and null parts are empty, null roles are the empty name; turns are ordered by turn (nulls first), then role,
then text, and repeated rows stay; rows with a null conv_id are one conversation; an empty table gives no
rows; extra columns are ignored.  Unknown kinds of parts raise.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ESCAPED = re.compile(r"[\\\[<]")
TURN = re.compile(r"(\[INST\]|<s>|<<SYS>>|\[ROLE\])((?:[^\\\[<]++|\\.|<\|\w+ \d+\|>|\[TEXT\])*+)(\[/INST\]|</s>|<</SYS>>|\[/ROLE\])", re.S)
ROLE = re.compile(r"((?:[^\\\[<]++|\\.)*+)\[TEXT\](.*)", re.S)
PLACEHOLDER = re.compile(r"(?<!\\)(?:\\\\)*(<\|(image|audio|document) (\d+)\|>)")
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 512


def escape(text: str) -> str:
    return ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Flatten:
    """Visitor over a turn's parts."""

    def __init__(self):
        self.text: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        if part is None:
            return
        getattr(self, f"visit_{part['kind']}", self.unknown)(part)

    def unknown(self, part: dict) -> None:
        raise ValueError(f"unknown kind of content part: {part['kind']}")

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part["text"] or ""))

    def attach(self, part: dict, tokens: int) -> None:
        self.attachments.append({"position": len(self.attachments) + 1, "kind": part["kind"], "uri": part["uri"], "tokens": tokens})
        self.text.append(f"<|{part['kind']} {len(self.attachments)}|>")

    def visit_image(self, part: dict) -> None:
        self.attach(part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, math.ceil((part["seconds"] or 0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part["pages"] or 0) * PAGE_TOKENS)


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, the range of its text (code points) and its attachments."""
    flat = Flatten()
    for part in parts:
        flat.visit(part)
    head, tail = MARKS.get(role, (f"[ROLE]{escape(role)}[TEXT]", "[/ROLE]"))
    body = "".join(flat.text)
    return head + body + tail, len(head), len(head) + len(body), flat.attachments


def read_turn(piece: str) -> tuple[str, str, list[tuple[str, int]]]:
    """Role, unescaped text (placeholders as they stand) and placeholders of a formatted turn."""
    found = TURN.fullmatch(piece)
    if not found:
        raise ValueError("not a formatted turn")
    head, body, _ = found.groups()
    if head == "[ROLE]":
        role, body = ROLE.fullmatch(body).groups()
        role = unescape(role)
    else:
        role = next(r for r, m in MARKS.items() if m[0] == head)
    return role, unescape(body), [(m[2], int(m[3])) for m in PLACEHOLDER.finditer(body)]


PIECE = ("conv_id long, turn long, role string, text string, piece string, loss_start int, loss_end int, "
         "attachments array<struct<position:int,kind:string,uri:string,tokens:int>>, tokens_attached long")


def format_turns(turns: DataFrame) -> DataFrame:
    """A formatted ``piece`` for each row of ``turns`` (conv_id, turn, role, and text or parts)."""
    parts = F.col("parts") if "parts" in turns.columns and "text" not in turns.columns else F.array(
        F.struct(F.lit("text").alias("kind"), F.col("text"), F.lit(None).cast("string").alias("uri"),
                 F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                 F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))
    text = F.col("text") if "text" in turns.columns else F.lit(None)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                        text.cast("string").alias("text"), parts.cast(f"array<{PART}>").alias("parts"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([
        ("position", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int32())])), pa.int64()]
    names = ["conv_id", "turn", "role", "text", "piece", "loss_start", "loss_end", "attachments", "tokens_attached"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, turn, role, text_, parts_ in zip(*(c.to_pylist() for c in b.columns)):
                piece, start, end, files = format_turn(role, parts_ or [])
                own = (start, end) if role == "assistant" else (None, None)
                out.append((conv, turn, role, text_, piece, *own, files, sum(f["tokens"] for f in files)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, PIECE)


def read_back(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: counts and digests of what its formatted pieces say."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def close() -> None:
            if now is not None:
                done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for b in batches:
            for conv, piece, start, end in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now[0] != conv:
                    close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, _ = read_turn(piece)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    masked = unescape(piece[start:end])
                    now[3] += len(masked)
                    now[4].update(masked.encode())
                now[5] += len(piece)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "piece")
    return dealt.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
