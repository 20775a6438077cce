"""Business sector of an industry code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope.model import SECTORS, UNCLASSIFIED, UNKNOWN


def sector_of(naics_code: Column) -> Column:
    """Sector name of a NAICS code: a literal-map lookup, so no join is needed."""
    names = F.create_map(*[F.lit(text) for pair in SECTORS.items() for text in pair])
    named = F.element_at(names, F.left(naics_code, F.lit(2)))
    return F.when(naics_code.isNull(), F.lit(UNKNOWN)).otherwise(
        F.coalesce(named, F.lit(UNCLASSIFIED))
    )
