"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. Nothing about it is
assumed: the turns of a conversation are rendered prefix after prefix, and what
each output adds to the one before is the span of its turn. Within the span, the
turn's text is found by rendering the prefix once more with a probe that does not occur
in the output as the last text. If an output does not begin with the one before, the template
rewrites history; the conversation is marked, and each turn is then located by
probing it in the whole conversation.

Defined cases: null text and null role are empty; turns are ordered by turn (null
first), then role, then text; repeated rows are turns of their own; a null
conv_id is a conversation of its own; an empty table gives no rows; other columns
are ignored. Rows of one conversation are streamed to one task in order, since
the digests are sequential; memory holds one conversation at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.session import ship, table

Turn = tuple[str, str]

#: Strings of the instruction template that a text may not contain as they are.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = "(?:" + "|".join(map(re.escape, CONTROLS)) + ")"
_ANY = re.compile(rf"\\*{_CONTROL}")
_ESCAPED = re.compile(rf"\\(\\*{_CONTROL})")


def escaped(text: str) -> str:
    """Each control string, with the backslashes before it, gets one backslash more."""
    return _ANY.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def instruction_template(turns: list[Turn]) -> str:
    """``<s>role [INST] text [/INST]</s>`` and a line end for each turn. No marker follows a text or role directly."""
    return "".join(f"<s>{escaped(role)} [INST] {escaped(text)} [/INST]</s>\n" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of :func:`instruction_template`."""
    marks = [m for m in _ANY.finditer(formatted) if not m[0].startswith("\\")]
    if len(marks) % 4:
        raise ValueError("markers are missing")
    turns = []
    for a, b, c, d in zip(*[iter(marks)] * 4, strict=True):
        if (a[0], b[0], c[0], d[0]) != ("<s>", "[INST]", "[/INST]", "</s>"):
            raise ValueError("markers are out of order")
        turns.append((unescaped(formatted[a.end() : b.start() - 1]), unescaped(formatted[b.end() + 1 : c.start() - 1])))
    return turns


@dataclass
class Formatted:
    text: str = ""
    #: where each turn, and its text within, lies in ``text``
    turns: list[tuple[int, int]] = field(default_factory=list)
    contents: list[tuple[int, int]] = field(default_factory=list)
    rewrites_history: bool = False


def _probe(out: str) -> str:
    """A private-use character that ``out`` lacks; if it has them all, the first pair of two different ones that it lacks."""
    letters = [chr(c) for c in range(0xE000, 0xF900)]
    used = set(out)
    for c in letters:
        if c not in used:
            return c
    pairs = {a + b for a, b in zip(out, out[1:], strict=False)}
    return next(a + b for a in letters for b in letters if a != b and a + b not in pairs)


def _content(render: Callable[[list[Turn]], str], turns: list[Turn], at: int, out: str) -> tuple[int, int]:
    """Where the text of turn ``at`` lies in ``out``, by rendering with a probe in its place."""
    probe = _probe(out)
    probed = render([*turns[:at], (turns[at][0], probe), *turns[at + 1 :]])
    start = probed.find(probe)
    if start < 0:  # the template leaves this text out
        n = len(os.path.commonprefix([probed, out]))
        return n, n
    return start, max(start, len(out) - (len(probed) - start - len(probe)))


def incremental(turns: list[Turn], render: Callable[[list[Turn]], str]) -> Formatted:
    """Render prefix after prefix and compare neighbours."""
    result, before = Formatted(), render([])
    for k in range(len(turns)):
        out = render(turns[: k + 1])
        if not out.startswith(before):
            result.rewrites_history = True
        same = len(before) if out.startswith(before) else len(os.path.commonprefix([out, before]))
        result.turns.append((same, len(out)))
        result.contents.append(_content(render, turns[: k + 1], k, out))
        before = out
    result.text = before
    if result.rewrites_history:
        result.contents = [_content(render, turns, k, before) for k in range(len(turns))]
        starts = [a for a, _ in result.contents] + [len(before)]
        result.turns = [(starts[k], max(starts[k], starts[k + 1])) for k in range(len(turns))]
    return result


FORMATTED = "formatted string, turn_spans array<struct<start:long,stop:long>>, loss_spans array<struct<start:long,stop:long>>, rewrites_history boolean"


def format_conversations(conversations: DataFrame, render: Callable[[list[Turn]], str] = instruction_template, learn: str = "assistant") -> DataFrame:
    """conv_id, formatted, turn_spans, loss_spans (texts of the role ``learn``) and rewrites_history, one row per conversation."""
    ship(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def done(groups):
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        as_spans = lambda pairs: [{"start": a, "stop": b} for a, b in pairs]
        found = [(conv, turns, incremental(turns, render)) for conv, turns in groups]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _, _ in found], key_type),
                pa.array([f.text for _, _, f in found], pa.string()),
                pa.array([as_spans(f.turns) for _, _, f in found], span),
                pa.array([as_spans(p for p, (role, _) in zip(f.contents, turns, strict=True) if role == learn) for _, turns, f in found], span),
                pa.array([f.rewrites_history for _, _, f in found], pa.bool_()),
            ],
            names=["conv_id", "formatted", "turn_spans", "loss_spans", "rewrites_history"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(kind)

    def run(batches):
        open_, turns, ready = None, [], []
        for batch in batches:
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if turns and conv != open_:
                    ready.append((open_, turns))
                    turns = []
                open_ = conv
                turns.append((role, text))
            if ready:
                yield done(ready)
                ready = []
        if turns:
            yield done([(open_, turns)])

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, {FORMATTED}")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations."""
    ship(formatted.sparkSession)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                seen = hashlib.sha256()
                for role, said in turns:
                    seen.update(f"{role}\n{said}\n".encode())
                loss = "".join(unescaped(text[s["start"] : s["stop"]]) for s in spans)
                for name, value in zip(out, (len(turns), seen.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)), strict=True):
                    out[name].append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]], names=["conv_id", *out])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, '(\\*(?:<s>|</s>|\[INST\]|\[/INST\]))', '\\\1', 'g') AS r, regexp_replace(text, '(\\*(?:<s>|</s>|\[INST\]|\[/INST\]))', '\\\1', 'g') AS t FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<s> [INST]  [/INST]</s>') + 1 + length(r) + length(t)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
