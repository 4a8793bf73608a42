"""Cleaning of names and cell values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the sense of Unicode, with the ASCII separators.
_SPACE = r"(?U)[\s\x1c-\x1f]"

# Where a name splits into words: symbols, a capitalised word, a capital after a small letter.
_WORD_BREAK = re.compile(r"[^A-Za-z0-9]+|(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])")


def snake_case(name: str) -> str:
    return "_".join(word for word in _WORD_BREAK.split(name) if word).lower()


def clean_cell(value: Column) -> Column:
    """Null for blank cells and '-'; otherwise trimmed, with runs of white space made one space."""
    blank = value.rlike(rf"^{_SPACE}*$") | (value == "-")
    inner = F.regexp_replace(value, rf"{_SPACE}+", " ")
    return F.when(~blank, F.trim(inner))


def is_blank(value: Column) -> Column:
    return value.isNull() | value.rlike(rf"^{_SPACE}*$")
