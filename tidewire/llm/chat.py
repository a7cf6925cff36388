"""Chat formatting with typed content parts, reversible escaping and a loss mask.

A message's content is a list of parts (``PARTS``): text, image, audio, document. A visitor flattens them in order: text is
escaped, every other part becomes a placeholder ``<|kind:index|>`` (numbered through the conversation), its reference is
recorded and its expanded token count worked out. Turns are framed as ``<|im_start|>role\\ncontent<|im_end|>\\n``.

Escaping: ``<`` and ``|`` with any number of backslashes between them get one more backslash, so no text can hold a control
string, and taking one backslash away restores it. In roles, ``\\`` and the line break are escaped too.

The loss mask is a list of [start, end) code point ranges of the formatted text: the text parts of each trained role.

Messages are rendered row by row before anything is grouped; a conversation is then one sorted list of rendered turns, so
only what has to stand in one row meets in one task. Turns with equal ``turn`` are ordered by role and content; null turns
come first. Null texts are empty, null roles are the empty role, a null or empty part list is an empty message, unknown
part kinds are an error. Repeated rows are repeated turns. A null conversation id is an id of its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

START, END = "<|im_start|>", "<|im_end|>\n"
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
ATTACHMENT = pa.struct([("index", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
RENDERED = pa.struct([
    ("role", pa.string()), ("content", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("attachments", pa.list_(ATTACHMENT)),
])
FORMATTED = pa.struct([
    ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("attachments", pa.list_(ATTACHMENT)), ("expanded_tokens", pa.int64()),
])
READ = pa.struct([
    ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("loss_text", pa.string()),
])

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_SLOT = re.compile(r"<\|(?:image|audio|document):\?\|>")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def part(kind: str, text: Column | None = None, ref: Column | None = None, width: Column | None = None,
         height: Column | None = None, seconds: Column | None = None, pages: Column | None = None) -> Column:
    """A content part as a column, for ``F.array(part("text", text=...), part("image", ref=...), ...)``."""
    values = [("text", text, "string"), ("ref", ref, "string"), ("width", width, "int"), ("height", height, "int"),
              ("seconds", seconds, "double"), ("pages", pages, "int")]
    return F.struct(F.lit(kind).alias("kind"), *[(F.lit(None) if v is None else v).cast(t).alias(n) for n, v, t in values])


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for once a model's input is built."""

    patch: int = 28
    audio_per_second: float = 12.5
    tokens_per_page: int = 256


@dataclass
class Flattener:
    """Visits the parts of one message in order."""

    expansion: Expansion
    content: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, item: dict) -> None:
        visitor = getattr(self, f"visit_{item['kind']}", None)
        if visitor is None:
            raise ValueError(f"unknown content part {item['kind']!r}")
        visitor(item)

    def visit_text(self, item: dict) -> None:
        self.text.append(item["text"] or "")  # neighbours are one text: a control string may begin in the first

    def close(self) -> None:
        """Write the text seen since the last placeholder."""
        text = escape("".join(self.text))
        self.text.clear()
        if text:
            self.spans.append({"start": self.length, "stop": self.length + len(text)})
            self._write(text)

    def visit_image(self, item: dict) -> None:
        across, down = (math.ceil((item[side] or 0) / self.expansion.patch) for side in ("width", "height"))
        self._attach(item, across * down)

    def visit_audio(self, item: dict) -> None:
        self._attach(item, math.ceil((item["seconds"] or 0) * self.expansion.audio_per_second))

    def visit_document(self, item: dict) -> None:
        self._attach(item, (item["pages"] or 0) * self.expansion.tokens_per_page)

    def _attach(self, item: dict, tokens: int) -> None:
        self.close()
        self.attachments.append({"index": len(self.attachments), "kind": item["kind"], "ref": item["ref"],
                                 "tokens": tokens})
        self._write(f"<|{item['kind']}:?|>")  # numbered when the conversation is put together

    def _write(self, text: str) -> None:
        self.content.append(text)
        self.length += len(text)


def render_message(role: str | None, parts: Sequence[dict] | None, expansion: Expansion = Expansion()) -> dict:
    flat = Flattener(expansion)
    for item in parts or []:
        flat.visit(item)
    flat.close()
    return {"role": role or "", "content": "".join(flat.content), "spans": flat.spans, "attachments": flat.attachments}


def assemble(messages: Sequence[dict], trained: frozenset[str]) -> dict:
    """Frame rendered messages, number their attachments through, and mark the text to be learned."""
    out, loss, attachments, at, tokens = [], [], [], 0, 0
    for message in messages:
        head = f"{START}{escape_role(message['role'])}\n"
        content, spans, first = message["content"], message["spans"], len(attachments)
        if message["attachments"]:
            content, spans = _numbered(content, spans, first)
        for item in message["attachments"]:
            attachments.append({**item, "index": first + item["index"]})
            tokens += item["tokens"]
        if message["role"] in trained:
            base = at + len(head)
            loss += [{"start": base + s["start"], "stop": base + s["stop"]} for s in spans]
        out += [head, content, END]
        at += len(head) + len(content) + len(END)
    return {"formatted": "".join(out), "loss": loss, "attachments": attachments, "expanded_tokens": tokens}


def _numbered(content: str, spans: Sequence[dict], first: int) -> tuple[str, list[dict]]:
    """Number the open placeholders of a message from ``first`` and move its spans along."""
    out, moves, last = [], [], 0
    for k, slot in enumerate(_SLOT.finditer(content)):
        number = str(first + k)
        out += [content[last:slot.end() - 3], number, "|>"]
        last = slot.end()
        moves.append((slot.end(), len(number) - 1))
    out.append(content[last:])
    shifted, k, move = [], 0, 0
    for span in spans:
        while k < len(moves) and moves[k][0] <= span["start"]:
            move += moves[k][1]
            k += 1
        shifted.append({"start": span["start"] + move, "stop": span["stop"] + move})
    return "".join(out), shifted


def read_back(formatted: str, loss: Sequence[dict]) -> dict:
    """Turns and learned text, from the formatted text alone. Placeholders stay in a turn's text."""
    turns, at = [], 0
    for turn in _TURN.finditer(formatted):
        if turn.start() != at:
            break
        turns.append({"role": unescape_role(turn[1]), "text": unescape(turn[2])})
        at = turn.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return {"turns": turns, "loss_text": "".join(unescape(formatted[s["start"]:s["stop"]]) for s in loss)}


def format_chats(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                 trained: Sequence[str] = ("assistant",), expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: ``key``, n_turns, formatted, loss, attachments, expanded_tokens."""
    roles = frozenset(trained)

    @F.arrow_udf(from_arrow_type(RENDERED))
    def render(role_batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, contents in role_batches:
            rows = [render_message(a, b, expansion) for a, b in zip(names.to_pylist(), contents.to_pylist())]
            yield pa.array(rows, type=RENDERED)

    @F.arrow_udf(from_arrow_type(FORMATTED))
    def frame(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [assemble([m["message"] for m in row], roles) for row in batch.to_pylist()]
            yield pa.array(rows, type=FORMATTED)

    rendered = df.select(F.col(key), F.col(turn).alias("turn"), render(F.col(role), F.col(parts)).alias("message"))
    turns = rendered.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("turn", "message"))).alias("_turns"))
    return turns.select(key, F.size("_turns").cast("bigint").alias("n_turns"), frame("_turns").alias("_f")).select(
        key, "n_turns", "_f.*")


def parse_chats(df: DataFrame, formatted: str = "formatted", loss: str = "loss") -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_text``, read back from formatted texts."""

    @F.arrow_udf(from_arrow_type(READ))
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, masks in batches:
            rows = [read_back(a, b) for a, b in zip(texts.to_pylist(), masks.to_pylist())]
            yield pa.array(rows, type=READ)

    return df.withColumn("_read", read(F.col(formatted), F.col(loss))).select("*", "_read.*").drop("_read")
