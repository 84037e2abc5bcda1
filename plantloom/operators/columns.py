"""Choosing and renaming columns; every operator is a single projection."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

from plantloom.checks import require_columns, require_names, require_text

log = logging.getLogger(__name__)


def pick(df: DataFrame, columns: Sequence[str], name: str = "input") -> DataFrame:
    """Exactly ``columns``, or a ValueError naming the missing ones."""
    require_columns(df, columns, name)
    return df.select(*columns)


def pick_present(df: DataFrame, columns: Sequence[str], name: str = "input") -> DataFrame:
    """Those of ``columns`` the input has; a ValueError when it has none."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"{name} has none of the columns {list(columns)}")
    if len(present) < len(columns):
        log.warning("%s lacks %s; going on without", name,
                    [c for c in columns if c not in present])
    return df.select(*present)


def first_present(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate that is a column of the input."""
    for name in candidates or ():
        if name in df.columns:
            return name
    raise ValueError(f"none of the columns {list(candidates or ())} is present")


def prefix_columns(df: DataFrame, prefix: str, exclude: Sequence[str] | None = None) -> DataFrame:
    """Rename every column ``c`` to ``prefix_c`` unless excluded."""
    require_text(prefix, "prefix")
    keep = [] if exclude is None else exclude
    require_names(keep, "exclude")
    return df.toDF(*[c if c in keep else f"{prefix}_{c}" for c in df.columns])


def strip_prefixes(df: DataFrame) -> DataFrame:
    """Cut every column name after its first underscore; names without one stay."""
    return df.toDF(*[c.partition("_")[2] if "_" in c else c for c in df.columns])
