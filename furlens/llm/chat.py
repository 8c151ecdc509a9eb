"""Chat formatting by a finite-state machine over roles.

A declarative template names each role's marks, whether its text is under the
loss, and which role may follow which. The machine walks over the turns of a
conversation, notes turns that are out of order, and emits segments: marks,
which are never under the loss, and texts with the flag of their role. Control
strings inside texts get a backslash after their first character, and
backslashes are doubled, so texts come back exactly.

Turns stream through sorted tasks one at a time: a conversation of any length
needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import table

TEMPLATE = {
    "roles": {
        "system": {"open": "<<SYS>>", "close": "<</SYS>>", "loss": False},
        "user": {"open": "[INST]", "close": "[/INST]", "loss": False},
        "assistant": {"open": "<s>", "close": "</s>", "loss": True},
    },
    # any other role is written out between these
    "other": {"open": "[ROLE]", "middle": "[TEXT]", "close": "[/ROLE]", "loss": False},
    "next": {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
}

FORMATTED = "conv_id long, turn long, in_order boolean, segments array<struct<text: string, loss: boolean>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"


class Machine:
    """The template as a machine; ``step`` takes a turn and gives its segments."""

    def __init__(self, template: dict = TEMPLATE):
        self.template = template
        marks = [m for role in (*template["roles"].values(), template["other"]) for k, m in role.items() if k != "loss"]
        self.control = re.compile("|".join(map(re.escape, sorted(marks, key=len, reverse=True))))
        self.roles = {role["open"]: name for name, role in template["roles"].items()}
        self.state = "start"

    def escaped(self, text: str) -> str:
        return self.control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    @staticmethod
    def unescaped(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def step(self, role: str, text: str) -> tuple[bool, list[tuple[str, bool]]]:
        """Whether the turn is in order, and its segments."""
        in_order = role in self.template["next"].get(self.state, [])
        self.state = role
        own = self.template["roles"].get(role)
        if own:
            return in_order, [(own["open"], False), (self.escaped(text), own["loss"]), (own["close"], False)]
        own = self.template["other"]
        head = own["open"] + self.escaped(role) + own["middle"]
        return in_order, [(head, False), (self.escaped(text), own["loss"]), (own["close"], False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn in a formatted string."""
        turns, other = [], self.template["other"]
        pieces, at = [], 0
        for m in self.control.finditer(formatted):
            pieces += [formatted[at : m.start()], m[0]]
            at = m.end()
        it = iter(pieces[1:])  # nothing stands before the first mark
        for mark in it:
            body = next(it)
            if mark == other["open"]:
                role, _, body = self.unescaped(body), next(it), next(it)
            else:
                role = self.roles[mark]
            turns.append((role, self.unescaped(body)))
            next(it), next(it, None)  # the closing mark and the nothing after it
        return turns


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _format(batches: Iterator[pa.RecordBatch], template: dict) -> Iterator[pa.RecordBatch]:
    machine, current = Machine(template), object()
    for batch in batches:
        out = [[], [], [], []]
        for conv_id, turn, role, text in _rows([batch], ["conv_id", "turn", "role", "text"]):
            if conv_id != current:
                current, machine.state = conv_id, "start"
            in_order, segments = machine.step(role, text)
            for column, value in zip(out, (conv_id, turn, in_order, [{"text": t, "loss": f} for t, f in segments])):
                column.append(value)
        segments_type = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
        arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.bool_()), pa.array(out[3], segments_type)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "turn", "in_order", "segments"])


def _digest(batches: Iterator[pa.RecordBatch], template: dict) -> Iterator[pa.RecordBatch]:
    machine, out, started = Machine(template), [], False
    current = n = loss_chars = chars = turns = loss = all_in_order = None

    def closed() -> pa.RecordBatch:
        fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=fields)

    def end() -> None:
        out.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, all_in_order))

    for conv_id, in_order, segments in _rows(batches, ["conv_id", "in_order", "segments"]):
        if not started or conv_id != current:
            if started:
                end()
                if len(out) >= 10_000:
                    yield closed()
                    out.clear()
            current, started = conv_id, True
            n, loss_chars, chars, all_in_order = 0, 0, 0, True
            turns, loss = hashlib.sha256(), hashlib.sha256()
        formatted = "".join(s["text"] for s in segments)
        for role, text in machine.read(formatted):
            n += 1
            turns.update(f"{role}\n{text}\n".encode())
        under = "".join(machine.unescaped(s["text"]) for s in segments if s["loss"])
        loss.update(under.encode())
        loss_chars += len(under)
        chars += len(formatted)
        all_in_order &= in_order
    if started:
        end()
    if out:
        yield closed()


def formatted(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn, in order within each task: conv_id, turn, in_order and segments.

    A conversation's formatted text is its segments in a row. A null text or
    role is empty; an empty or unknown role is written with its name and is out
    of order. Rows without conv_id form one conversation. Turns go by number,
    null first; equal numbers by role and text, so repeated rows are repeated
    turns. An empty table gives no rows. Other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(partial(_format, template=template), FORMATTED)


def digests(turns: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """What is read back from the output of ``formatted``, one row per conversation."""
    return turns.mapInArrow(partial(_digest, template=template), DIGEST)


PROBE = "</s>[INST] ok [/INST]"


def op5_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return digests(formatted(rows.union(probe)))


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(t)
), m AS (
  SELECT *,
    length(text) + (length(text) - length(replace(text, '\', '')))
    + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|</s>|<s>|\[ROLE\]|\[TEXT\]|\[/ROLE\]'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE length(role) + 19 END AS chars,
    lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(coalesce((before = 'start' AND role IN ('system', 'user')) OR (before IN ('system', 'assistant') AND role = 'user') OR (before = 'user' AND role = 'assistant'), false)) AS in_order
FROM m GROUP BY conv_id
"""
