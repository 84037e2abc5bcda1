"""Marked spans of a text: (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "array<struct<kind: string, start: long, end: long>>"


def as_rows(spans: Sequence[tuple[str, int, int]]) -> list[dict]:
    """What a pandas UDF of type ``TYPE`` returns for one text."""
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def of_kinds(spans: str, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


def count_of(spans: str, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order the spans are in."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans).cast("binary"), 256)
