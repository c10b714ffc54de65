"""Chat formatting with a compiled template, and reading the output back.

A conversation's rows are brought together by a shuffle on its id, sorted
inside the partition and streamed through the template: memory holds one
Arrow batch and one part of the output, however long a conversation is.  (A
conversation is one running text, so one task writes it.)  The output comes in
parts of bounded size cut between turns, with the spans under the loss mask.

Control strings inside texts get a backslash before them, as backslashes do;
the reader undoes it, so every text comes back exactly.

Cases
-----
* null text or role: empty; null turn numbers come first; rows with equal
  turns are ordered by role, then text; repeated rows are turns of their own;
* rows with a null conversation id form one conversation of id null;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import bound_batches
from skygrid.llm.template import compile_template

TURN_END = "</turn>"
HEADER = "### "
# Escaped within texts; roles also hide line ends, which close a header.
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|\n")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|\n)")
_STOP = re.compile(r"\\(?:\\|###|</turn>)|</turn>")
_ROLE = re.compile(r"### ((?:\\.|[^\\\n])*):\n", re.S)

TEMPLATE = (
    "{% for m in messages %}"
    "### {{ m.role | escape_role }}:{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>{{ '\\n' }}"
    "{% endfor %}")
PART_CHARS = 1 << 20


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS = {"escape": escape, "escape_role": lambda s: _ROLE_CONTROL.sub(r"\\\g<0>", s)}


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of every turn in formatted text that holds whole turns."""
    at = 0
    while at < len(text):
        head = _ROLE.match(text, at)
        if not head:
            raise ValueError(f"no turn header at {at}")
        for m in _STOP.finditer(text, head.end()):
            if m.group() == TURN_END:
                break
        else:
            raise ValueError(f"turn at {at} is not closed")
        yield unescape(head[1]), unescape(text[head.end():m.start()])
        at = m.end() + 1


def _parts(pieces: Iterator[tuple[str, bool]], part_chars: int):
    """``(text, masked spans)`` of whole turns, of about ``part_chars`` characters."""
    held, spans, size = [], [], 0
    for text, masked in pieces:
        if masked and text:
            if spans and spans[-1][1] == size:
                spans[-1] = (spans[-1][0], size + len(text))
            else:
                spans.append((size, size + len(text)))
        held.append(text)
        size += len(text)
        if size >= part_chars and not masked and text.endswith(TURN_END + "\n"):
            yield "".join(held), spans
            held, spans, size = [], [], 0
    if held:
        yield "".join(held), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         part_chars: int = PART_CHARS) -> DataFrame:
    """``(conv_id, part, text, spans)``: the formatted conversations.

    ``part`` counts from 0; ``spans`` are the ``start, end`` character offsets
    under the loss mask.  Rows of a conversation follow one another in order.
    """
    rows = turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bound_batches(turns.sparkSession)
    compile_template(template, filters=FILTERS)      # fail here, not in a task
    kind = rows.schema["conv"].dataType.simpleString()
    ordered = (rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
               .select("conv", "role", "text"))

    def run(batches):
        render = compile_template(template, filters=FILTERS)
        types: list = []

        def stream():
            for batch in batches:
                types[:] = [batch.schema.field(0).type]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        held: list = []
        size = 0
        for conv, group in itertools.groupby(stream(), key=lambda r: r[0]):
            messages = ({"role": r[1], "text": r[2]} for r in group)
            for k, (text, spans) in enumerate(_parts(render(messages=messages), part_chars)):
                held.append((conv, k, text, [{"start": a, "end": b} for a, b in spans]))
                size += len(text)
                if size >= part_chars or len(held) >= 4096:
                    yield _batch(held, types[0])
                    held, size = [], 0
        if held:
            yield _batch(held, types[0])

    return ordered.mapInArrow(run, f"conv {kind}, part long, text string, spans array<struct<start:long,end:long>>"
                              ).withColumnRenamed("conv", id_col)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(rows: list, conv_type: pa.DataType) -> pa.RecordBatch:
    conv, part, text, spans = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, conv_type), pa.array(part, pa.int64()), pa.array(text, pa.string()),
         pa.array(spans, _SPANS)], names=["conv", "part", "text", "spans"])


def read_back_digests(formatted: DataFrame, id_col: str = "conv_id", in_order: bool = False) -> DataFrame:
    """Per conversation, digests of what is read back from the formatted parts.

    ``in_order``: the parts of each conversation already follow one another in
    one partition, as :func:`format_conversations` leaves them.
    """
    rows = formatted.select(F.col(id_col).alias("conv"), "part", "text", "spans")
    if not in_order:
        rows = rows.repartition("conv").sortWithinPartitions("conv", "part")
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        conv_type: list = []

        def stream():
            for batch in batches:
                conv_type[:] = [batch.schema.field(0).type]
                yield from zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                               batch.column(3).to_pylist(), strict=True)

        def flush(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], conv_type[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2]),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4]), pa.array(cols[5], pa.int64())],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        out: list = []
        for conv, parts in itertools.groupby(stream(), key=lambda r: r[0]):
            n, chars, loss_chars = 0, 0, 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for _, text, spans in parts:
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescape(text[span["start"]:span["end"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 4096:
                yield flush(out)
                out = []
        if out:
            yield flush(out)

    return rows.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                           "loss_sha256 string, formatted_chars long").withColumnRenamed("conv", id_col)
