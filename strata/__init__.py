"""strata: layered-table pipelines (raw -> cleaned -> aggregated) on Spark.

Every table is a declarative spec; one generic operator per layer turns a
spec into a lazy DataFrame plan that Catalyst optimises as a whole.
"""

from strata.operators.clean import clean, refresh_cleaned
from strata.operators.dedupe import dedupe
from strata.operators.joins import checked_join
from strata.operators.summarise import summarise
from strata.plans.pipeline import (LayerConfig, refresh_layers, run_clean_layer, run_pipeline,
                                   run_raw_layer, run_summary_layer)
from strata.sinks.tables import compact_table, publish, reset_tables
from strata.specs import CleanSpec, JoinSpec, LoadSpec, Metric, SummarySpec

__version__ = "0.1.0"

__all__ = [
    "CleanSpec", "JoinSpec", "LayerConfig", "LoadSpec", "Metric", "SummarySpec",
    "checked_join", "clean", "compact_table", "dedupe", "publish", "refresh_cleaned",
    "refresh_layers", "reset_tables", "run_clean_layer", "run_pipeline", "run_raw_layer",
    "run_summary_layer", "summarise",
]
