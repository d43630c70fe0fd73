"""Chat formatting: typed content parts flattened into one marked string, reversibly.

A turn has a role and content parts: text, image, audio or document. A visitor flattens the parts in order; each part that
isn't text becomes one numbered placeholder, its reference is recorded with the tokens it expands to, and adjacent texts are
one text. A part of any other type becomes a placeholder `other` that expands to no tokens; its type is kept in the record.
Missing, negative or endless sizes count as 0. The template marks turns by control strings that begin with `<|`; inside texts
and roles a backslash is doubled, `<|` becomes `<\\|` and, in roles, a newline `\\N`, so that no text can forge a mark or a
placeholder, and roles, texts and placeholders can be read back in their order.

The loss mask is a list of ranges of code points of the output: the texts of assistant turns, without marks and placeholders.
Turns are ordered by turn, then role, then parts; null turns come first, null roles and texts are empty, repeated rows are
turns of their own. A conversation is one output value, so its turns meet in one task; different conversations, however many
share a first turn, don't. Columns beyond the four aren't looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<turn:bigint,part:int,type:string,ref:string,n_tokens:bigint>"
#: Kinds of placeholders. The last one stands for parts of unknown type.
KINDS = ("image", "audio", "document", "other")
_ESCAPED = re.compile(r"\\(.)", re.S)
#: An escaped character, or a placeholder.
_TOKEN = re.compile(rf"\\.|<\|({'|'.join(KINDS)}):(\d+)\|>", re.S)
_BACK = {"N": "\n"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK.get(m[1], m[1]), text)


@dataclass(frozen=True)
class Config:
    #: Pixels a side of an image's patches, tokens a second of audio, tokens a page of a document without text.
    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 256
    loss_role: str = "assistant"


def _size(x) -> float:
    return x if x is not None and 0 < x < math.inf else 0


@dataclass
class Visitor:
    """Flattens the parts of one conversation."""

    config: Config
    attachments: list[dict] = field(default_factory=list)

    def content(self, turn: int | None, parts: list[dict]) -> list[tuple[bool, str]]:
        """Pieces of the output in order, and whether each is a text."""
        out: list[tuple[bool, str]] = []
        for is_text, run in groupby(enumerate(parts), lambda kp: (kp[1].get("type") or "text") == "text"):
            if is_text:
                out.append((True, escape("".join(p.get("text") or "" for _, p in run))))
                continue
            for k, p in run:
                kind = p["type"] if p["type"] in KINDS[:-1] else KINDS[-1]
                out.append((False, f"<|{kind}:{len(self.attachments)}|>"))
                self.attachments.append({"turn": turn, "part": k, "type": p["type"], "ref": p.get("ref"), "n_tokens": getattr(self, f"visit_{kind}")(p)})
        return out

    def visit_image(self, p: dict) -> int:
        side = lambda n: math.ceil(_size(n) / self.config.patch)
        return side(p.get("width")) * side(p.get("height"))

    def visit_audio(self, p: dict) -> int:
        return math.ceil(_size(p.get("seconds")) * self.config.audio_rate)

    def visit_document(self, p: dict) -> int:
        return int(_size(p.get("pages"))) * self.config.page_tokens

    def visit_other(self, p: dict) -> int:
        return 0


def format_turns(turns: list[tuple[int | None, str, list[dict]]], config: Config = Config()) -> tuple[str, list[dict], list[dict]]:
    """The marked string, loss ranges and attachments of (turn, role, parts) in order."""
    v, out, loss, at = Visitor(config), [], [], 0
    for turn, role, parts in turns:
        head = START + escape(role).replace("\n", "\\N") + "\n"
        pieces = [(False, head), *v.content(turn, parts), (False, END + "\n")]
        for is_text, piece in pieces:
            if is_text and role == config.loss_role:
                loss.append({"start": at, "end": at + len(piece)})
            at += len(piece)
        out += [piece for _, piece in pieces]
    return "".join(out), loss, v.attachments


def parse(formatted: str) -> list[tuple[str, list[dict]]]:
    """(role, parts) of each turn: texts, and the kind and number of each placeholder, in order."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, body = turn.partition("\n")
        if not body.endswith(END + "\n"):
            raise ValueError("a turn doesn't end")
        body, parts, at = body[: -len(END) - 1], [], 0
        for m in _TOKEN.finditer(body):
            if m[1]:
                parts += [{"type": "text", "text": unescape(body[at : m.start()]), "number": None}, {"type": m[1], "text": None, "number": int(m[2])}]
                at = m.end()
        parts.append({"type": "text", "text": unescape(body[at:]), "number": None})
        out.append((unescape(role), [p for p in parts if p["text"] != ""]))
    return out


def as_text_parts(text: str = "text"):
    """The content parts of a plain text column."""
    return F.expr(f"array(cast(named_struct('type', 'text', 'text', `{text}`, 'ref', null, 'width', null, 'height', null, 'seconds', null, 'pages', null) as {PART}))")


def format_conversations(rows: DataFrame, config: Config = Config(), id_: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row for each id: n_turns, formatted, loss (ranges) and attachments. parts: an array of PART; null is none."""
    turns = rows.select(F.col(id_).alias("conv_id"), F.struct(F.col(turn).cast("bigint").alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(F.col(parts), F.expr(f"cast(array() as array<{PART}>)")).alias("parts")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    id_type = grouped.schema["conv_id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    found = pa.list_(pa.struct([("turn", pa.int64()), ("part", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                turns = [[(t["turn"], t["role"], t["parts"]) for t in c] for c in part.column("turns").to_pylist()]
                got = [format_turns(t, config) for t in turns]
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), pa.array([len(t) for t in turns], pa.int64()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], spans), pa.array([g[2] for g in got], found)], names=["conv_id", "n_turns", "formatted", "loss", "attachments"])

    return grouped.mapInArrow(run, f"conv_id {id_type}, n_turns bigint, formatted string, loss array<struct<start:int,end:int>>, attachments array<{ATTACHMENT}>")


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with `turns` (role, text and parts) and `loss_text`, the unescaped text under the loss ranges, both read from the string."""
    base = formatted.drop("turns", "loss_text")
    columns = base.columns
    piece = pa.struct([("type", pa.string()), ("text", pa.string()), ("number", pa.int32())])
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("parts", pa.list_(piece))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            turns, loss = [], []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss").to_pylist(), strict=True):
                turns.append([{"role": r, "text": "".join(p["text"] or "" for p in parts), "parts": parts} for r, parts in parse(text)])
                loss.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(turns, kind), pa.array(loss, pa.string())], names=[*columns, "turns", "loss_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, schema + ", turns array<struct<role:string,text:string,parts:array<struct<type:string,text:string,number:int>>>>, loss_text string")
