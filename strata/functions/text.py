"""Text normalisation.

``trim`` removes only U+0020 at both ends; tab and no-break space stay.
NULL stays NULL and an all-blank string becomes ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_spaces(col: str | Column) -> Column:
    return F.trim(F.col(col) if isinstance(col, str) else col)


def lower_trim(col: str | Column) -> Column:
    """E-mail style normalisation: ``lower(trim(x))``."""
    return F.lower(trim_spaces(col))


def upper_trim(col: str | Column) -> Column:
    """Code style normalisation: ``upper(trim(x))``."""
    return F.upper(trim_spaces(col))
