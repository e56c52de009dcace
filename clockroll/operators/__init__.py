from clockroll.operators.aggregate import OUTPUT_COLUMNS, finalize_stats, rollup, rollup_many, stats_aggs
from clockroll.operators.lateness import (classify_arrivals, classify_many, emissions,
                                          emissions_many, object_clock,
                                          open_windows_at_end, with_clock)
from clockroll.operators.merge import upsert, upsert_combine

__all__ = ["OUTPUT_COLUMNS", "finalize_stats", "rollup", "rollup_many", "stats_aggs",
           "classify_arrivals", "classify_many", "emissions", "emissions_many", "object_clock", "open_windows_at_end",
           "with_clock", "upsert", "upsert_combine"]
