"""Column functions used by the specs (all built-in Spark expressions)."""

from strata.functions.audit import INGESTION_TIME, with_ingestion_time
from strata.functions.text import lower_trim, trim_spaces, upper_trim
from strata.functions.dates import date_key

__all__ = [
    "INGESTION_TIME",
    "with_ingestion_time",
    "lower_trim",
    "trim_spaces",
    "upper_trim",
    "date_key",
]
