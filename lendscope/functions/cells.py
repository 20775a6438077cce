"""Turning raw text cells into values.

All expressions are JVM built-ins, so they stay inside whole-stage code
generation; none raises under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.model import MONEY, WHITESPACE

SYMBOLS = "$,%"
_PLAIN = r"^[0-9]{1,18}(\.0{1,9})?\z"

# What stands between packed cells, and what marks an unknown cell or an escaped character.
_BETWEEN, _MARK = "\x1f", "\x1e"

# Month first with slashes, else ISO.
SLASH_DATE, ISO_DATE = "M/d/yyyy", "yyyy-MM-dd"


def null_tokens(cell: Column, tokens: Sequence[str]) -> Column:
    """A4: the cell, or null when it is exactly one of ``tokens``."""
    return F.when(~cell.isin(*tokens), cell)


def strip(cell: Column) -> Column:
    """The cell without white space (of any script) at its ends.

    ``trim`` with an explicit character set is a byte scan; a regular
    expression would be compiled code per cell and ``trim`` alone only knows
    the plain space.
    """
    return F.btrim(cell, F.lit(WHITESPACE))


def blank_to_null(cell: Column) -> Column:
    """The cell unchanged, or null when it is empty or only white space."""
    return F.when(strip(cell) != "", cell)


def without_symbols(cell: Column) -> Column:
    """The cell without currency, thousands and percent signs.

    ``translate`` looks every character up, so it is left to cells that hold a sign.
    """
    return F.when(has_symbols(cell), F.translate(cell, SYMBOLS, "")).otherwise(cell)


def packed(texts: Sequence[Column]) -> Column:
    """Cells of text as one text, equal for equal cells only; ``unpacked`` gives them back."""

    def one(cell: Column) -> Column:
        marked = F.contains(cell, F.lit(_MARK)) | F.contains(cell, F.lit(_BETWEEN))
        escaped = F.replace(
            F.replace(cell, F.lit(_MARK), F.lit(f"{_MARK}m")), F.lit(_BETWEEN), F.lit(f"{_MARK}b")
        )
        return F.when(cell.isNull(), _MARK).when(marked, escaped).otherwise(cell)

    return F.concat_ws(_BETWEEN, *map(one, texts))


def parts(text: Column) -> Column:
    """The parts of a packed text, for ``unpacked``."""
    return F.split(text, _BETWEEN)


def unpacked(found: Column, count: int) -> list[Column]:
    """The cells that ``packed`` made one text of, from its parts."""

    def one(part: Column) -> Column:
        opened = F.replace(
            F.replace(part, F.lit(f"{_MARK}b"), F.lit(_BETWEEN)), F.lit(f"{_MARK}m"), F.lit(_MARK)
        )
        return F.when(part == _MARK, None).when(F.contains(part, F.lit(_MARK)), opened).otherwise(part)

    return [one(found[i]) for i in range(count)]


def to_decimal(cell: Column, kind: T.DecimalType = MONEY) -> Column:
    """Text to an exact number; null when it is not one."""
    return without_symbols(cell).try_cast(kind)


def to_integer(cell: Column, kind: T.DataType = T.IntegerType()) -> Column:
    """Text to a whole number; null when it has a fraction or does not fit.

    Goes through a decimal because ``12.0`` and ``1e5`` are whole numbers that
    a direct cast to an integer type refuses.  The remainder of a decimal is slow, so
    plain digits, with or without zeros behind a point, go without.
    """
    plain = cell.rlike(_PLAIN)
    number = without_symbols(cell).try_cast(T.DecimalType(38, 18))
    return F.when(plain, F.substring_index(cell, ".", 1).try_cast(kind)).when(
        number % 1 == 0, number.try_cast(kind)
    )


def to_date(cell: Column) -> Column:
    """Text to a date, as month/day/year or ISO; null otherwise.

    A slash decides which of the two to try: a failed try is slow.
    """
    slashed = F.contains(cell, F.lit("/"))
    return F.when(slashed, F.try_to_date(cell, SLASH_DATE)).otherwise(
        F.try_to_date(cell, ISO_DATE)
    )


def to_type(cell: Column, kind: T.DataType) -> Column:
    """Coerce a text cell to the type its column has in the loans table."""
    if isinstance(kind, T.DecimalType):
        return to_decimal(cell, kind)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return to_integer(cell, kind)
    if isinstance(kind, T.DateType):
        return to_date(cell)
    return cell


def coercion_failed(cell: Column, value: Column) -> Column:
    """There was text, and it gave no value."""
    return cell.isNotNull() & value.isNull()


def has_symbols(cell: Column) -> Column:
    """The text holds a currency, thousands or percent sign."""
    return reduce(or_, [F.contains(cell, F.lit(s)) for s in SYMBOLS])
