r"""Chat formatting with a grammar round trip.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` for every turn, in order. The
parser is deterministic and strict: neither a role nor a text may hold a
control string as it stands, a role ends at the first line feed, and an escape
is undone: ``<\|`` is ``<|``, ``<\\|`` is ``<\|`` and so on; in a role also
``\n`` and ``\\``. A turn is first rendered as it is and parsed again; if the
turn that comes back is not the source turn, its content is escaped (one
backslash more in every ``<\...\|``) and the check repeated until it is.

Output: parts of conversations. A part holds whole turns of one conversation
and the spans (code points within the part) that carry the training loss, the
assistants' texts. Parts of a conversation follow each other by ``part``; most
have one. Turns are dealt by ranges of (conversation, turn, role, text), so a
conversation of any length is shared out and never held as a whole.

Cases: null texts and roles are empty; turns with the same number go by role,
then text; repeated rows are turns of their own; null turn numbers come first;
rows with a null conversation id form one conversation; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.store import prepare

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
PART_CHARS = 1 << 20

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPED = re.compile(r"\\([\\n])")
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Malformed(ValueError):
    """Formatted text that the grammar does not accept."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of formatted text: role, text, and the span of the text as it stands there."""
    at = 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if not formatted.startswith(START, at) or line < 0:
            raise Malformed(f"no turn at {at}")
        role, begin = formatted[at + len(START):line], line + 1
        end = formatted.find(END, begin)
        if end < 0 or not formatted.startswith("\n", end + len(END)):
            raise Malformed(f"no end of the turn at {at}")
        if "<|" in role or "<|" in formatted[begin:end]:
            raise Malformed(f"control string inside the turn at {at}")
        yield unescape_role(role), unescape(formatted[begin:end]), begin, end
        at = end + len(END) + 1


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn that parses back to itself, and the span of its text."""
    shown_role, shown = role, text
    while True:
        head = f"{START}{shown_role}\n"
        whole = f"{head}{shown}{END}\n"
        try:
            back = [(r, t) for r, t, _, _ in parse(whole)]
        except Malformed:
            back = []
        if back == [(role, text)]:
            return whole, len(head), len(head) + len(shown)
        if (shown_role, shown) == (escape_role(role), escape(text)):
            raise Malformed("an escaped turn does not parse back")
        shown_role, shown = escape_role(role), escape(text)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, formatted, loss (array of spans)."""
    prepare(turns.sparkSession)
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keys = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32  # ranges follow each other in order of partition
        out: list[tuple] = []
        conv, part, shown, spans, size = None, first, [], [], 0

        def close():
            nonlocal shown, spans, size, part
            if shown:
                out.append((conv, part, "".join(shown), spans))
                shown, spans, size, part = [], [], 0, part + 1

        def flush():
            columns = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), _SPAN)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                              names=["conv_id", "part", "formatted", "loss"])

        for batch in batches:
            for row_conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if row_conv != conv or size > part_chars:
                    close()
                    conv = row_conv
                turn, begin, end = render(role.as_py(), text.as_py())
                if role.as_py() == LOSS_ROLE:
                    spans.append({"start": size + begin, "end": size + end})
                shown.append(turn)
                size += len(turn)
            yield flush()
        close()
        yield flush()

    return rows.mapInArrow(run, "conv_id long, part long, formatted string, loss array<struct<start int, end int>>")


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of what formatted conversations say: one row per conversation.

    Parts of a conversation are read in order, one at a time: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    prepare(parts.sparkSession)
    rows = parts.select("conv_id", "part", "formatted", "loss") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        state, out = None, []

        def close():
            if state:
                out.append((state["conv"], state["turns"], state["all"].hexdigest(), state["chars"],
                            state["loss"].hexdigest(), state["size"]))

        def flush():
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for conv, formatted, spans in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if state is None or state["conv"] != conv:
                    close()
                    state = {"conv": conv, "turns": 0, "chars": 0, "size": 0,
                             "all": hashlib.sha256(), "loss": hashlib.sha256()}
                formatted = formatted.as_py()
                for role, text, _, _ in parse(formatted):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode("utf-8"))
                for span in spans.as_py():
                    text = unescape(formatted[span["start"]:span["end"]])
                    state["chars"] += len(text)
                    state["loss"].update(text.encode("utf-8"))
                state["size"] += len(formatted)
            yield flush()
        close()
        yield flush()

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long")
