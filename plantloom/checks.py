"""Argument and column checks shared by all operators; they run while a plan is built."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_frame(value: object, name: str) -> None:
    if not isinstance(value, DataFrame):
        raise TypeError(f"{name} must be a Spark DataFrame, got {type(value).__name__}")


def require_columns(df: DataFrame, columns: Iterable[str], name: str = "input") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks required columns {missing}")


def require_names(value: object, name: str) -> None:
    if not isinstance(value, (list, tuple)) or not all(isinstance(v, str) for v in value):
        raise ValueError(f"{name} must be a list of column names")


def require_text(value: object, name: str, error: type[Exception] = ValueError) -> None:
    if not isinstance(value, str):
        raise error(f"{name} must be a string")


def require_distinct(names: Iterable[str], context: str) -> None:
    repeated = [n for n, times in Counter(names).items() if times > 1]
    if repeated:
        raise ValueError(f"{context} would hold more than one column named {repeated}")
