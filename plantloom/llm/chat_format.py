"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record is JSON of any known layout. Its fingerprint is a hash of its sorted
nested field paths, as far as any mapping mentions them; the registry has a
fingerprint for every mapping and every choice of its optional fields. The
mapping says, as data, which paths become which turns.

Canonical turns are written with a template that marks turns with control
strings. Control strings inside roles and texts are escaped: ``ESCAPE`` goes
after their first character, and is doubled wherever a text has it itself, so
reading back restores every text. The loss mask covers assistant texts.

Turns are formatted where they lie. A conversation is read in order of its
turns from sorted partitions, piece by piece, and never held as a whole.

Defined results: null texts and roles count as empty; null turn numbers come
first, equal ones in order of role and text; a null conversation id is a
conversation; repeated rows are repeated turns. A record of unknown layout, or
that is no JSON, has null ``layout`` and no turns, and its fingerprint says why;
it is returned as a row without role and text, never left out. The caller's
columns travel as one struct ``row``, so no name of theirs clashes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.tables import packed, quoted, read, ready_for_python

# The template's control strings and the mark that defuses them in texts.
OPEN, HEAD_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROLS = r"<s>|</s>|\[INST\]|\[/INST\]"
ESCAPE = "␛"
ASSISTANT = "assistant"

TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(HEAD_END) + "(.*?)" + re.escape(CLOSE), re.DOTALL)


@dataclass(frozen=True)
class Say:
    """One turn from the record's own fields; several filled ones are set apart by blank lines."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class SayAs:
    """One turn whose role is a field too."""

    role_path: str
    path: str


@dataclass(frozen=True)
class Each:
    """One turn per element of a list; element fields by name."""

    list_path: str
    role: str
    text: str


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths it needs, the paths it may have, and its turns in order."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Say | SayAs | Each, ...]
    may: tuple[str, ...] = ()
    # a turn that is left out when its only fields are absent or empty
    skip_empty: tuple[str, ...] = field(default=("system",))
    # the layout's own names for canonical roles; others are taken as they are
    roles: dict[str, str] = field(default_factory=dict)


# Names that lists of messages have for the canonical roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant"}

MAPPINGS = (
    Mapping("row", ("role", "text"), (SayAs("role", "text"),)),
    Mapping("messages", ("messages[].role", "messages[].content"),
            (Say("system", ("system",)), Each("messages", "role", "content")), ("system",),
            roles=ROLES),
    Mapping("conversations", ("conversations[].from", "conversations[].value"),
            (Say("system", ("system",)), Each("conversations", "from", "value")), ("system",),
            roles=ROLES),
    Mapping("instruction", ("instruction", "output"),
            (Say("system", ("system",)), Say("user", ("instruction", "input")),
             Say("assistant", ("output",))), ("input", "system")),
    Mapping("prompt_completion", ("prompt", "completion"),
            (Say("system", ("system",)), Say("user", ("prompt",)),
             Say("assistant", ("completion",))), ("system",)),
    Mapping("prompt_response", ("prompt", "response"),
            (Say("system", ("system",)), Say("user", ("prompt",)),
             Say("assistant", ("response",))), ("system",)),
    Mapping("question_answer", ("question", "answer"),
            (Say("user", ("context", "question")), Say("assistant", ("answer",))), ("context",)),
)
KNOWN = frozenset(p for m in MAPPINGS for p in (*m.needs, *m.may))


def field_paths(value, path: str = "") -> set[str]:
    """Nested field paths of a JSON value; lists add ``[]``, empty ones and objects end there."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{path}[]"} if not value else set(),
                           *(field_paths(v, f"{path}[]") for v in value))
    return {path}


def fingerprint(paths) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(paths)))


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint of every variant of every mapping."""
    return {fingerprint({*m.needs, *some}): m for m in mappings
            for k in range(len(m.may) + 1) for some in combinations(m.may, k)}


REGISTRY = registry()


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: str | None) -> dict:
    """Fingerprint, layout and turns (canonical role, role as given, text) of one record."""
    try:
        value = json.loads(record or "")
    except ValueError:
        value = None
    if not isinstance(value, dict):
        return {"fingerprint": fingerprint(()), "layout": None, "turns": []}
    mark = fingerprint(field_paths(value) & KNOWN)
    mapping = REGISTRY.get(mark)
    turns = []
    for step in mapping.turns if mapping else ():
        if isinstance(step, Each):
            found = [(_text(e.get(step.role)), _text(e.get(step.text))) for e in value[step.list_path]]
        elif isinstance(step, SayAs):
            found = [(_text(value[step.role_path]), _text(value[step.path]))]
        else:
            parts = [t for t in (_text(value.get(p)) for p in step.paths) if t]
            found = [] if not parts and step.role in mapping.skip_empty else [
                (step.role, "\n\n".join(parts))]
        turns.extend({"role": mapping.roles.get(r, r), "given": r, "text": t} for r, t in found)
    return {"fingerprint": mark, "layout": mapping.name if mapping else None, "turns": turns}


def canonical_turns(records: DataFrame, record: str) -> DataFrame:
    """A row per turn: ``row`` with the other columns, fingerprint, layout, place in the record,
    role, role as given, text.

    A record without turns has one row with nulls.
    """
    ready_for_python(records.sparkSession)

    @F.pandas_udf("fingerprint string, layout string, "
                  "turns array<struct<role: string, given: string, text: string>>")
    def read_record(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([canonical(t) for t in texts], columns=["fingerprint", "layout", "turns"])

    rest = [quoted(c) for c in records.columns if c != record]
    found = records.select(F.struct(*rest).alias("row") if rest else F.struct(F.lit(None).alias("_")).alias("row"),
                           read_record(quoted(record)).alias("_c"))
    return found.select("row", "_c.fingerprint", "_c.layout",
                        F.posexplode_outer("_c.turns").alias("place", "_t")).select(
        "row", "fingerprint", "layout", "place", "_t.role", F.col("_t.given").alias("given_role"), "_t.text")


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, rf"(?=(?:{CONTROLS}))(.)", f"$1{ESCAPE}")


def unescaped(text: str) -> str:
    return re.sub(f"{ESCAPE}({ESCAPE}?)", r"\1", text)


def formatted(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Turns as ``row``, with ``formatted`` and the part of it under the loss mask.

    That is from ``loss_start`` to ``loss_end``, in code points; -1 where nothing
    is learnt. A conversation's text is its turns' texts in order.
    """
    written = packed(turns, head=F.concat(F.lit(OPEN), escaped(quoted(role)), F.lit(HEAD_END)),
                     body=escaped(quoted(text)), learnt=quoted(role).eqNullSafe(ASSISTANT))
    start, end = F.length("head"), F.length("head") + F.length("body")
    return written.select("row", F.concat("head", "body", F.lit(CLOSE)).alias("formatted"),
                          F.when(F.col("learnt"), start).otherwise(-1).alias("loss_start"),
                          F.when(F.col("learnt"), end).otherwise(-1).alias("loss_end"))


class _Reader:
    """Digests of one conversation, read from its formatted turns."""

    def __init__(self):
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.said, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, start: int, end: int) -> None:
        for found in TURN.finditer(text):
            self.turns += 1
            self.said.update(f"{unescaped(found[1])}\n{unescaped(found[2])}\n".encode())
        self.chars += len(text)
        if start >= 0:
            learnt = unescaped(text[start:end])
            self.loss_chars += len(learnt)
            self.learnt.update(learnt.encode())

    def row(self) -> tuple:
        return (self.turns, self.said.hexdigest(), self.loss_chars, self.learnt.hexdigest(), self.chars)


READ = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def read_back(rows: DataFrame, conversation: str, order: list[str]) -> DataFrame:
    """Per conversation what its formatted text says, read from that text in order.

    ``conversation`` and ``order`` name fields of ``row``, with dots for nested ones.

    Rows stream through in sorted order; a digest is in one piece by nature, so
    a conversation is read by one task, which holds one turn of it at a time.
    """
    lined = rows.select(F.col(f"row.{conversation}").alias("key"), "formatted", "loss_start", "loss_end",
                        *[F.col(f"row.{c}").alias(f"o{i}") for i, c in enumerate(order)])
    kind = lined.schema["key"].dataType.simpleString()
    names = ["key", *[part.split()[0] for part in READ.split(", ")]]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, done = None, None, []

        def batch(found, like):
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], like)] + [pa.array(c) for c in columns[1:]], names)

        like = None
        for part in batches:
            like = part.schema.field(0).type
            for key, text, start, end in zip(*(part.column(i).to_pylist() for i in range(4))):
                if reader is None or key != now:
                    if reader is not None:
                        done.append((now, *reader.row()))
                    reader, now = _Reader(), key
                reader.add(text, start, end)
            if len(done) >= 1000:
                yield batch(done, like)
                done = []
        if reader is not None:
            done.append((now, *reader.row()))
        if done:
            yield batch(done, like)

    sort = [F.col(c).asc_nulls_first() for c in ("key", *(f"o{i}" for i in range(len(order))))]
    lined = lined.repartition("key").sortWithinPartitions(*sort)
    return lined.select("key", "formatted", "loss_start", "loss_end").mapInArrow(
        stream, f"key {kind}, {READ}").withColumnRenamed("key", conversation.split(".")[-1])


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    records = table.unionByName(hard).select("conv_id", "turn", F.to_json(
        F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    rows = formatted(canonical_turns(records, "record"))
    return read_back(rows, "row.conv_id", ["row.turn", "place", "role", "text"])


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT CAST(-7 AS BIGINT), i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
  FROM range(2) t(i)),
n AS (
  SELECT *, length(role) + length(text) + length(role || text) - length(replace(role || text, '␛', ''))
         + len(regexp_extract_all(role, '<s>|</s>|\[INST\]|\[/INST\]'))
         + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]')) + 20 AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
              FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
