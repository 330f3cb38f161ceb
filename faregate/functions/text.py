"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numbered_label(prefix: str, number: Column, width: int = 3) -> Column:
    return F.format_string(f"{prefix} %0{width}d", number)


def before(text: Column, delimiter: str) -> Column:
    return F.substring_index(text, delimiter, 1)


def first_line_head(text: Column, length: int = 80) -> Column:
    """The first ``length`` characters of the first line; null stays null."""
    return F.substring(F.substring_index(text, "\n", 1), 1, length)


def label_of(code: Column, labels: dict[int, str], otherwise: str = "other") -> Column:
    """Text for a code; missing and unknown codes get ``otherwise``."""
    expr: Column | None = None
    for value, label in labels.items():
        expr = (
            F.when(code == value, F.lit(label))
            if expr is None
            else expr.when(code == value, F.lit(label))
        )
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))
