"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (role, text) to a string. The
operator does not look inside it: it renders successive prefixes of a
conversation and compares consecutive outputs. If the longer output starts with
the shorter one, what was added is the turn's span; if not, the template has
rewritten history, and the turn where it first did so is reported. Where the
text lies in its span comes from two more renderings whose last text is a probe
character: they differ exactly there.

``marked`` is the template used by default: every turn is
``<s>role[INST]text[/INST]</s>`` and a line end; control strings inside roles and
texts are broken up by a backslash, and backslashes doubled, so the output can be
read back exactly.

A conversation is one row of the output, so it is rendered in one task, one
conversation in memory at a time; rendering prefixes takes time in proportion to
its length times its number of turns.

Defined cases: turns are in order of turn (null first), then role, then text, so
repeated and tied rows have a fixed place; null text and null role count as empty;
rows whose conv_id is null form one conversation; an empty text has an empty span;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

OPEN, MIDDLE, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (OPEN, MIDDLE, CLOSE, END, "<<SYS>>", "<</SYS>>")
LOSS_ROLES = ("assistant",)
OUTPUT_BYTES = 4 << 20
_PROBES = ("\ue000", "\ue001")  # private-use characters: no template has them in its marks


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked(turns: list[Turn]) -> str:
    return "".join(f"{OPEN}{escape(r)}{MIDDLE}{escape(t)}{CLOSE}{END}\n" for r, t in turns)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked``."""
    out = []
    for part in formatted.split(f"{CLOSE}{END}\n")[:-1]:
        role, _, text = part.partition(MIDDLE)
        out.append((unescape(role.removeprefix(OPEN)), unescape(text)))
    return out


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def locate(turns: list[Turn], template: Template) -> tuple[str, list[dict], int | None]:
    """The rendered conversation, a span per turn (whole turn, and its text),
    and the first turn whose rendering changed earlier output (None: none did).
    After a rewrite, spans are those of the output up to that turn."""
    spans: list[dict] = []
    before, rewritten = "", None
    for k, (role, text) in enumerate(turns):
        after = template(turns[:k + 1])
        start = len(before)
        if not after.startswith(before):
            start = _common(before, after)
            rewritten = k if rewritten is None else rewritten
        first, second = (template([*turns[:k], (role, p)]) for p in _PROBES)
        at = _common(first, second)
        tail = len(first) - at - 1
        fits = at < len(first) and after[:at] == first[:at] and after[len(after) - tail:] == first[at + 1:]
        lo, hi = (at, len(after) - tail) if fits else (start, len(after))  # the text steers the marks: take it all
        spans.append({"turn": k, "role": role, "start": start, "end": len(after), "text_start": lo, "text_end": hi,
                      "loss": role in LOSS_ROLES})
        before = after
    return before, spans, rewritten


_SPAN = ("struct<turn:int,role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint,loss:boolean>")


def _span_type() -> pa.DataType:
    return pa.list_(pa.struct([("turn", pa.int32()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())]))


def format_chats(turns: DataFrame, template: Template = marked) -> DataFrame:
    """(conv_id, formatted, spans, rewritten) for every conversation of
    ``turns`` (conv_id, turn, role, text)."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, spans, rewrites, held, id_type = [], [], [], [], 0, None
        now, open_id, started = [], None, False

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(texts, pa.string()), pa.array(spans, _span_type()),
                 pa.array(rewrites, pa.int32())], names=["conv_id", "formatted", "spans", "rewritten"])

        def finish():
            formatted, found, rewritten = locate(now, template)
            ids.append(open_id)
            texts.append(formatted)
            spans.append(found)
            rewrites.append(rewritten)
            return len(formatted)

        for b in batches:
            id_type = b.column(0).type
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if started and conv != open_id:
                    held += finish()
                    now = []
                    if held > OUTPUT_BYTES:
                        yield flush()
                        ids, texts, spans, rewrites, held = [], [], [], [], 0
                started, open_id = True, conv
                now.append((role, text))
        if started:
            finish()
            yield flush()

    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return (ordered.select("conv_id", "role", "text")
            .mapInArrow(run, f"conv_id {kind}, formatted string, spans array<{_SPAN}>, rewritten int"))


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from outputs of ``marked``: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2)):
                text = text.as_py()
                turns = read_turns(text)
                whole, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                for s in spans:
                    if s["loss"].as_py():
                        said = unescape(text[s["text_start"].as_py():s["text_end"].as_py()])
                        loss.update(said.encode())
                        chars += len(said)
                out.append((len(turns), whole.hexdigest(), chars, loss.hexdigest(), len(text)))
            cols = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return (formatted.select("conv_id", "formatted", "spans")
            .mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                             "loss_sha256 string, formatted_chars bigint"))
