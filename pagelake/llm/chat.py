"""Chat formatting with typed content parts.

A message's content is a list of typed parts.  A visitor flattens them in
order: text is escaped and kept; image, audio and document parts become
placeholders ``<|image:K|>``, ``<|audio:K|>``, ``<|document:K|>``, where ``K``
numbers the conversation's attachments, and each leaves an attachment record
(number, kind, reference, expanded token count).

Template, per turn: ``<|im_start|>ROLE\\nCONTENT<|im_end|>\\n``.  Every control
string contains ``<|``.  Inside texts ``<`` + k backslashes + ``|`` gets one
backslash more, so ``<|`` never occurs there, and dropping one backslash
restores the text.  Roles are escaped likewise, and their line breaks and
percent signs are percent-coded.  The loss mask lists (start, length) in code
points of the assistant's text parts; placeholders and markers are outside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
IMAGE_TILE = 512          # an image costs IMAGE_TOKENS for each tile of this many pixels a side
IMAGE_TOKENS = 170
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 500

PART = "type string, text string, ref string, width long, height long, seconds double, pages long"
FORMATTED = ("conv_id {id}, n_turns long, formatted string, loss_spans array<struct<start:long,length:long>>, "
             "attachments array<struct<number:int,kind:string,ref:string,tokens:long>>, extra_tokens long")

_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")
_HOLDER = re.compile(r"<\|(?:image|audio|document):\d+\|>")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


@dataclass
class PartVisitor:
    """Flattens the parts of one conversation, turn by turn."""

    out: list[str] = field(default_factory=list)
    at: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[int, str, str | None, int]] = field(default_factory=list)
    learn: bool = False

    def emit(self, s: str) -> None:
        self.out.append(s)
        self.at += len(s)

    def turn(self, role: str | None, parts: Iterable[dict]) -> None:
        self.learn = role == "assistant"
        self.emit(START + escape_role(role or "") + "\n")
        # neighbouring text parts are one text: an escape must see across their border
        run: list[str] = []
        for part in parts:
            if part["type"] == "text":
                run.append(part.get("text") or "")
                continue
            self.text("".join(run))
            run = []
            visit = getattr(self, "visit_" + str(part["type"]), None)
            if visit is None:
                raise ValueError(f"unknown content part {part['type']!r}")
            visit(part)
        self.text("".join(run))
        self.emit(END)

    def text(self, text: str) -> None:
        text = escape(text)
        if self.learn and text:
            self.spans.append((self.at, len(text)))
        self.emit(text)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        self.attachments.append((n, kind, part.get("ref"), tokens))
        self.emit(f"<|{kind}:{n}|>")

    def visit_image(self, part: dict) -> None:
        tiles = _ceil(max(1, part.get("width") or 1), IMAGE_TILE) * _ceil(max(1, part.get("height") or 1), IMAGE_TILE)
        self.attach("image", part, IMAGE_TOKENS * tiles)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, _ceil(int((part.get("seconds") or 0.0) * AUDIO_TOKENS_PER_SECOND * 1000), 1000))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, DOCUMENT_TOKENS_PER_PAGE * max(0, part.get("pages") or 0))


def format_messages(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows (``conv_id``, ``turn``, ``role``,
    ``parts`` array of ``PART`` structs): ``formatted``, ``loss_spans``,
    ``attachments`` and ``extra_tokens`` (expanded counts of all attachments).

    Turns are ordered by ``turn`` (null first), then role, then content, so
    ties and repeated rows have one order and all are kept.  Null role: empty;
    null or empty parts: an empty turn; a null part text: empty.  A null
    conversation id is a conversation.  Unknown part types raise.  Other
    columns are ignored; an empty table gives no rows.  A conversation is one
    output string, so its turns meet in one task: its memory is that string.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "parts"))).alias("turns"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for lo in range(whole.num_rows):  # a conversation at a time
                b = whole.slice(lo, 1)
                v = PartVisitor()
                rows = b.column(1)[0].as_py() or []
                for r in rows:
                    v.turn(r["role"], [p for p in r["parts"] or [] if p is not None])
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([len(rows)], pa.int64()), pa.array(["".join(v.out)], pa.string()),
                    pa.array([[{"start": s, "length": n} for s, n in v.spans]],
                             pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array([[dict(zip(("number", "kind", "ref", "tokens"), a)) for a in v.attachments]],
                             pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()),
                                                 ("tokens", pa.int64())]))),
                    pa.array([sum(a[3] for a in v.attachments)], pa.int64()),
                ], names=["conv_id", "n_turns", "formatted", "loss_spans", "attachments", "extra_tokens"])

    return grouped.mapInArrow(run, FORMATTED.format(id=id_type))


def text_parts(conversations: DataFrame) -> DataFrame:
    """Rows (``conv_id``, ``turn``, ``role``, ``text``) as one text part each
    (null text: empty)."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("width"),
                    F.lit(None).cast("long").alias("height"), F.lit(None).cast("double").alias("seconds"),
                    F.lit(None).cast("long").alias("pages"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.array(part).alias("parts"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation;
    placeholders stay as they are."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, body = turn.partition("\n")
        if not body.endswith(END):
            raise ValueError("a turn has no end marker")
        body = body[:-len(END)]
        held = _HOLDER.findall(body)
        texts = [unescape(t) for t in _HOLDER.split(body)]
        out.append((unescape_role(role), "".join(t + h for t, h in zip(texts, [*held, ""]))))
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, from ``formatted`` and ``loss_spans``
    alone: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256``, ``formatted_chars``."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for whole in batches:
            for lo in range(whole.num_rows):
                b = whole.slice(lo, 1)
                text, spans = b.column(1)[0].as_py(), b.column(2)[0].as_py()
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["start"] + s["length"]]) for s in spans)
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([len(turns)], pa.int64()),
                    pa.array([sha("".join(f"{r}\n{t}\n" for r, t in turns))]),
                    pa.array([len(loss)], pa.int64()), pa.array([sha(loss)]), pa.array([len(text)], pa.int64()),
                ], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
