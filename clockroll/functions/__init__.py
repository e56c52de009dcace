from clockroll.functions.timefn import (date_key, epoch_ms, format_ts, ms_to_minutes,
                                        ntz_from_ms, window_start_ms)
from clockroll.functions.units import (ADVANCED_UNITS, BASIC_UNITS, is_target_unit,
                                       with_stdev)

__all__ = ["date_key", "epoch_ms", "format_ts", "ms_to_minutes", "ntz_from_ms",
           "window_start_ms", "ADVANCED_UNITS", "BASIC_UNITS", "is_target_unit", "with_stdev"]
