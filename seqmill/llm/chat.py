r"""Operator 9: chat formatting that is checked by a grammar round trip.

A turn is rendered as::

    ### <role>
    <text>
    </turn>

with control strings ``###`` and ``</turn>`` and the escape character ``\``.
Each rendered turn is read again by a deterministic parser and compared with
its source. Where they differ, because the text holds a control string or
backslashes that read as escapes, the content is escaped and checked again; if
it still differed, that would be an error. So most texts stay as they are, and
every text comes back code point by code point.

Rendering and checking are done before rows are gathered by conversation; the
shuffle moves rendered turns, and what reads a conversation back streams over
its sorted turns with running hashes, so a conversation of any length needs
the memory of a batch of turns. The parser reads a turn once, left to right.

Defined results: null texts and roles are empty; turns that tie are ordered by
their rendered form; null turns come first; rows with a null conversation id
are one conversation; repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, out_batch, prepare, table

OPEN, CLOSE, ESCAPE = "###", "</turn>", "\\"
#: A run of escaped backslashes, or one escape; what else the parser stops at, and where content ends.
_RUN, _ONE = r"((?:\\\\)+)", r"\\(###|</turn>{})?"
_ESCAPED = re.compile(_RUN + r"|\\(###|</turn>)")
_STOPS = {stop: re.compile("|".join((_RUN, _ONE.format(line), f"({re.escape(stop)})", "###", "</turn>"))) for stop, line in (("\n", r"|\n"), ("\n</turn>\n", ""))}


def escape(text: str, line: bool = False) -> str:
    """Every backslash and control string behind a backslash; in a role, line ends too."""
    text = text.replace(ESCAPE, ESCAPE * 2).replace(OPEN, ESCAPE + OPEN).replace(CLOSE, ESCAPE + CLOSE)
    return text.replace("\n", ESCAPE + "\n") if line else text


def unescape(text: str) -> str:
    """The text of rendered content."""
    return _ESCAPED.sub(lambda m: m[2] or m[1][: len(m[1]) // 2], text)


class Broken(ValueError):
    """Text that is no sequence of turns."""


def _content(raw: str, at: int, stop: str) -> tuple[str, int]:
    """Content from ``at`` up to an unescaped ``stop``, and the place after that; an unescaped control string is an error."""
    end = raw.find(stop, at)
    plain = raw[at:end] if end >= 0 else ESCAPE
    if ESCAPE not in plain and OPEN not in plain and CLOSE not in plain:
        return plain, end + len(stop)
    out = []
    for m in _STOPS[stop].finditer(raw, at):
        out.append(raw[at : m.start()])
        at = m.end()
        if m[1]:
            out.append(m[1][: len(m[1]) // 2])
        elif m[3]:
            return "".join(out), at
        elif m[0][0] == ESCAPE:
            out.append(m[2] or ESCAPE)
        else:
            raise Broken(f"control string at {m.start()}")
    raise Broken("content has no end")


#: What closes a turn; the line end before it belongs to the template.
_END = "\n" + CLOSE + "\n"


def parse(raw: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the span of the rendered text of each turn."""
    out, at = [], 0
    while at < len(raw):
        if not raw.startswith(OPEN + " ", at):
            raise Broken(f"no turn at {at}")
        role, start = _content(raw, at + len(OPEN) + 1, "\n")
        text, at = _content(raw, start, _END)
        out.append((role, text, start, at - len(_END)))
    return out


def _shown(role: str, text: str) -> str:
    return f"{OPEN} {role}\n{text}{_END}"


def render(role: str, text: str) -> str:
    """A turn that parses to itself: as it is, or escaped where that is needed."""
    for shown in (_shown(role, text), _shown(role, escape(text)), _shown(escape(role, line=True), escape(text))):
        try:
            if [t[:2] for t in parse(shown)] == [(role, text)]:
                return shown
        except Broken:
            continue
    raise Broken("a turn doesn't come back")


def render_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, rendered`` of every row, each checked by the round trip."""
    prepare(rows.sparkSession)
    rows = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("rendered", pa.string())])

    def run(batches):
        for batch in batches:
            for a, b in chunks(batch, "text"):
                part = batch.slice(a, b - a)
                shown = [render(r or "", t or "") for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)]
                yield out_batch(schema, (part.column("conv_id"), part.column("turn"), shown))

    return rows.mapInArrow(run, "conv_id long, turn long, rendered string")


def format_conversations(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), **cols: str) -> DataFrame:
    """The formatted conversations as turns in order.

    ``conv_id, position, rendered, start, loss_start, loss_end``: a
    conversation is its turns' ``rendered`` one after another; ``start`` is the
    turn's first code point in it, and the loss mask covers the code points
    from ``loss_start`` up to ``loss_end`` of the conversation, null for turns
    that aren't trained on.
    """
    return _streamed(render_turns(rows, **cols), _Spans(loss_roles), "conv_id long, position long, rendered string, start long, loss_start long, loss_end long")


def digests(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), **cols: str) -> DataFrame:
    """What is read back from each formatted conversation: its turns, its loss text and its size."""
    return _streamed(render_turns(rows, **cols), _Digests(loss_roles), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


class _Spans:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())

    def __init__(self, roles):
        self.roles = roles

    def begin(self, conv):
        self.conv, self.n, self.at = conv, 0, 0

    def turn(self, rendered, out):
        ((role, _, a, b),) = parse(rendered)
        mine = role in self.roles
        out.append((self.conv, self.n, rendered, self.at, self.at + a if mine else None, self.at + b if mine else None))
        self.n += 1
        self.at += len(rendered)

    def end(self, out):
        pass


class _Digests:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def __init__(self, roles):
        self.roles = roles

    def begin(self, conv):
        self.conv, self.n, self.loss, self.size = conv, 0, 0, 0
        self.turns, self.text = hashlib.sha256(), hashlib.sha256()

    def turn(self, rendered, out):
        ((role, text, a, b),) = parse(rendered)
        self.n += 1
        self.size += len(rendered)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8"))
        if role in self.roles:
            masked = unescape(rendered[a:b])  # the mask's own code points
            self.loss += len(masked)
            self.text.update(masked.encode("utf-8"))

    def end(self, out):
        out.append((self.conv, self.n, self.turns.hexdigest(), self.loss, self.text.hexdigest(), self.size))


def _streamed(turns: DataFrame, reader, schema: str) -> DataFrame:
    """Conversations' turns in order through ``reader``, which holds one turn and its running values."""
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = pa.schema(list(zip(names, reader.kinds, strict=True)))
    turns = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "rendered")

    def run(batches):
        current, open_, out = None, False, []
        for batch in batches:
            for conv, rendered in zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist(), strict=True):
                if not open_ or conv != current:
                    if open_:
                        reader.end(out)
                    reader.begin(conv)
                    current, open_ = conv, True
                reader.turn(rendered, out)
            if out:
                yield out_batch(arrow, map(list, zip(*out, strict=True)))
                out = []
        if open_:
            reader.end(out)
        if out:
            yield out_batch(arrow, map(list, zip(*out, strict=True)))

    return turns.mapInArrow(run, schema)


#: A conversation that is hard to format.
HARD = -7, "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(HARD[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD[1]).alias("text"))
    return digests(rows.unionByName(hard))


SQL = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (
  SELECT *, CASE WHEN contains(text, '###') OR contains(text, '</turn>') OR contains(text, '\\')
    THEN replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') ELSE text END AS body
  FROM every)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ') + length(role) + 1 + length(body) + length('</turn>') + 2) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""
