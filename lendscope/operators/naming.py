"""Column names: headers to table columns (B1, B2)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame

from lendscope.model import HEADER_ALIASES


class HeaderCollision(ValueError):
    """Two headers of one file stand for the same column."""


def to_snake_case(header: str) -> str:
    """B1: ``BorrName`` to ``borr_name``; runs of other signs become one ``_``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", header)
    return "_".join(re.findall(r"[0-9A-Za-z]+", spaced)).lower()


def canonical_name(header: str) -> str:
    """B2: the table column a header stands for, else its snake_case form."""
    snake = to_snake_case(header)
    return HEADER_ALIASES.get(snake.replace("_", ""), snake)


def canonical_names(headers: Iterable[str]) -> list[str]:
    """B2 for a whole header row; refuses two headers with one meaning."""
    headers = list(headers)
    names = [canonical_name(h) for h in headers]
    twice = [name for name, n in Counter(names).items() if n > 1]
    if twice:
        clash = {name: [h for h, m in zip(headers, names) if m == name] for name in twice}
        raise HeaderCollision(f"headers that stand for the same column: {clash}")
    return names


def standardize_column_names(df: DataFrame) -> DataFrame:
    """B2 applied to a DataFrame; only metadata changes."""
    return df.toDF(*canonical_names(df.columns))
