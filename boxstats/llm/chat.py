r"""Operator 12: chat formatting of typed content parts.

A visitor flattens the parts of each turn (text, image, audio, document) into one string with a
placeholder for each attachment, in order, and records what it stands for. A turn is written as::

    <|im_start|>role
    text <|image|> text<|im_end|>

Texts cannot forge control strings: a ``<``, any number of backslashes and a ``|`` get one
backslash more, which reading back takes away again. In roles, backslashes, line ends and ``<`` are
written as ``\\``, ``\n`` and ``\l``.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxstats.llm.common import in_order, saved, small

START, END = "<|im_start|>", "<|im_end|>\n"
PARTS = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,"
         "pages:int>>")
SPANS = "array<struct<start:long,end:long>>"
ATTACHMENTS = "array<struct<kind:string,ref:string,at:long,n_tokens:long>>"
PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|attachment)\|>")
ROLE_CODES = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
ROLE_TEXTS = {code: text for text, code in ROLE_CODES.items()}


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<]", lambda m: ROLE_CODES[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nl]", lambda m: ROLE_TEXTS[m[0]], role)


@dataclass(frozen=True)
class TokenCosts:
    """Tokens an attachment expands to: one for each image patch of ``patch`` pixels square,
    ``audio_rate`` a second, ``page`` a document page."""
    patch: int = 28
    audio_rate: int = 25
    page: int = 256


@dataclass
class Flattener:
    """Visits the parts of one turn; neighbouring texts are escaped as one."""
    costs: TokenCosts
    body: str = ""
    texts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[str, str | None, int, int]] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.texts.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        sides = [math.ceil((part[c] or 0) / self.costs.patch) for c in ("width", "height")]
        self.attach("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        seconds = part["seconds"] or 0.0
        self.attach("audio", part, math.ceil(seconds * self.costs.audio_rate)
                    if math.isfinite(seconds) else 0)

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part["pages"] or 0) * self.costs.page)

    def visit_other(self, part: dict) -> None:
        self.attach("attachment", part, 0)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.close_text()
        self.attachments.append((kind, part["ref"], len(self.body), max(tokens, 1)))
        self.body += f"<|{kind}|>"

    def close_text(self) -> None:
        text = escape("".join(self.texts))
        if text:
            self.spans.append((len(self.body), len(self.body) + len(text)))
            self.body += text
        self.texts.clear()


def format_turn(role: str | None, parts: list[dict], costs: TokenCosts) -> tuple:
    """(formatted turn, spans of its texts, attachments), places counted in code points."""
    head = f"{START}{escape_role(role or '')}\n"
    flat = Flattener(costs, head)
    for part in parts:
        if part is not None:
            flat.visit(part)
    flat.close_text()
    return flat.body + END, flat.spans, flat.attachments


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; its attachments are left out."""
    if not (formatted.startswith(START) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, body = formatted[len(START):-len(END)].split("\n", 1)
    return unescape_role(role), "".join(unescape(t) for t in PLACEHOLDER.split(body))


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", parts_col: str | None = None,
                loss_roles: tuple[str, ...] = ("assistant",),
                costs: TokenCosts = TokenCosts()) -> DataFrame:
    """One segment per input row: conv_id, seq (place in its conversation), formatted, start (code
    points of the conversation before it), loss (spans of the conversation under the loss mask: the
    texts of ``loss_roles``), attachments (kind, ref, at: place of the placeholder in the
    conversation, n_tokens it expands to) and n_tokens (of all its attachments). A conversation's
    segments, one after the other, are its formatted text.

    The content is ``text_col``, or ``parts_col`` of the type ``PARTS`` if it is given. Turns are in
    the order of ``turn_col`` (null first), equal ones by a hash of role and content; repeated rows
    are turns each; a null conversation is one of its own; a null role or text is empty; a null
    part is skipped, a part without kind is text, one of an unknown kind an attachment; missing or
    unusable sizes count one token. No rows give no rows.

    Rows are dealt by ranges of (conversation, turn) and formatted where they lie, so one
    conversation with very many turns spreads over tasks; places inside a conversation are local
    ones plus the sums of the ranges before.
    """
    content = F.col(parts_col).cast(PARTS) if parts_col else F.col(text_col).cast("string")
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"),
                        F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), content.alias("content"))
    rows = in_order(rows.withColumn("tie", F.xxhash64("role", "content")), "conv_id", "turn",
                    "tie").select("conv_id", "role", "content")
    typed = parts_col is not None
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    attachment = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()),
                                     ("at", pa.int64()), ("n_tokens", pa.int64())]))

    def run(batches):
        conv, seq, start = None, 0, 0
        for batch in batches:
            out: list[tuple] = []
            for conv_id, role, value in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != conv:
                    conv, seq, start = conv_id, 0, 0
                parts = (value or []) if typed else [{"kind": "text", "text": value}]
                text, spans, attached = format_turn(role, parts, costs)
                loss = spans if role in loss_roles else []
                out.append((seq, text, start, len(text),
                            [{"start": start + a, "end": start + b} for a, b in loss],
                            [{"kind": k, "ref": r, "at": start + at, "n_tokens": n}
                             for k, r, at, n in attached], sum(a[3] for a in attached)))
                seq, start = seq + 1, start + len(text)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), span, attachment, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([o[i] for o in out], k)
                                    for i, k in enumerate(kinds)]],
                names=["conv_id", "seq", "formatted", "start", "size", "loss", "attachments",
                       "n_tokens"])

    local = rows.mapInArrow(run, "conv_id long, seq long, formatted string, start long, size long, "
                                 f"loss {SPANS}, attachments {ATTACHMENTS}, n_tokens long")
    part = F.shiftright(F.monotonically_increasing_id(), 33).alias("part")
    local = saved(local.select("*", part), "segments")
    # The ranges of a conversation: one for most, so a conversation in one range needs no shift.
    ranges = local.groupBy("conv_id", "part").agg(F.count("*").alias("turns"),
                                                  F.sum("size").alias("size"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = saved(ranges.select("conv_id", "part", F.sum("turns").over(before).alias("turns"),
                                 F.sum("size").over(before).alias("chars"))
                   .where("turns IS NOT NULL"), "shifts")
    shifts = small(shifts.withColumnsRenamed({"conv_id": "conv", "part": "range"}))
    moved = local.join(shifts, F.col("conv_id").eqNullSafe(F.col("conv"))
                       & (F.col("part") == F.col("range")), "left")
    chars = F.coalesce("chars", F.lit(0).cast("long"))
    return moved.select(
        "conv_id", (F.col("seq") + F.coalesce("turns", F.lit(0).cast("long"))).alias("seq"),
        "formatted", (F.col("start") + chars).alias("start"),
        F.transform("loss", lambda s: F.struct((s["start"] + chars).alias("start"),
                                               (s["end"] + chars).alias("end"))).alias("loss"),
        F.transform("attachments", lambda a: F.struct(
            a["kind"].alias("kind"), a["ref"].alias("ref"), (a["at"] + chars).alias("at"),
            a["n_tokens"].alias("n_tokens"))).alias("attachments"), "n_tokens")


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from its segments alone: conv_id, n_turns, turns_sha256 (role, line end,
    text, line end of each turn), loss_chars and loss_sha256 (the text under the loss mask,
    unescaped) and formatted_chars.

    A digest takes its bytes one after the other, so a conversation is read by one task, whatever
    its size; it streams past in sorted order, and the memory is one batch and two digests."""
    rows = (segments.select("conv_id", "seq", "start", "formatted", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "seq"))

    def run(batches):
        conv, known = None, None
        for batch in batches:
            out = []
            for conv_id, _, start, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if known is None or conv_id != conv:
                    if known:
                        out.append((conv, *finished(known)))
                    conv, known = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                known[0] += 1
                known[1].update(f"{role}\n{said}\n".encode())
                for s in loss:
                    under = unescape(text[s["start"] - start:s["end"] - start])
                    known[2] += len(under)
                    known[3].update(under.encode())
                known[4] += len(text)
            yield summary(out)
        if known:
            yield summary([(conv, *finished(known))])

    def finished(known):
        turns, all_text, chars, under, size = known
        return turns, all_text.hexdigest(), chars, under.hexdigest(), size

    def summary(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, "
                                "loss_chars long, loss_sha256 string, formatted_chars long")
