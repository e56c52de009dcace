"""Run counters: parser in/out/NaN (per query or micro-batch, via ``observe``) and the
upsert action counters (returned by :meth:`RollupTable.apply`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

PARSE_COUNTERS = ("records_in", "records_out", "records_nan")


def _counters():
    return [F.count(F.lit(1)).alias("records_in"),
            F.count_if(F.col("reason").isNull()).alias("records_out"),
            F.count_if(F.col("reason") == "nan").alias("records_nan")]


def observe_parse(parsed: DataFrame, name: str = "parse") -> tuple[DataFrame, Observation | None]:
    """Attach parser counters to a parsed measure frame.

    Batch: returns an ``Observation`` whose ``get`` is filled when an action on the returned
    frame finishes.  Stream: returns ``None``; the counters of every micro-batch appear in
    ``query.lastProgress["observedMetrics"][name]``."""
    if parsed.isStreaming:
        return parsed.observe(name, *_counters()), None
    obs = Observation(name)
    return parsed.observe(obs, *_counters()), obs
