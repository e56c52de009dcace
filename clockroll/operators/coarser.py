"""Coarser rollups from stored rows, without the records.

A target row holds all that merging needs: counts, sums, extremes, the last value with its time, and the
variance sums around the row's own ``k``.  The rows of a coarser window are merged by moving their
sums to one ``k``, that of its earliest window: with d = k_i - k, k_sum grows by k_sum_i + n_i d and k_sum_2 by
k_sum_2_i + 2 d k_sum_i + n_i d^2.  Merging is associative, so 15 to 60 to 1440 minutes gives what 15 to
1440 gives.  One shuffle by the coarser window; its rows are at most the ratio of the sizes.

All columns equal those of a rollup of the records, but ``k`` (and the sums around it): the first value
by arrival of the earliest window, as stored rows no longer tell which window's record came first.
Without ``k`` in all rows (units without a deviation) the coarser row has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clockroll.functions.timefn import window_start_ms
from clockroll.operators.aggregate import OUTPUT_COLUMNS, with_keys


def coarser(rows: DataFrame, minutes: int, align: str = "epoch") -> DataFrame:
    """Target rows of windows of ``minutes`` from rows of one finer granularity that divides it."""
    ws = F.unix_millis(F.col("timestamp").cast("timestamp"))
    fine = rows.withColumn("ws_ms", window_start_ms(ws, minutes, align)).withColumn("_from", ws)
    fits = (F.col("minutes") <= minutes) & (F.lit(minutes) % F.col("minutes") == 0)
    fine = fine.withColumn("minutes", F.when(fits, F.lit(minutes)).otherwise(
        F.raise_error(F.concat(F.lit(f"{minutes} minutes cannot be made of windows of "), F.col("minutes").cast("string")))).cast("int"))
    key = ["minutes", "object_id", "ws_ms"]
    fine = fine.withColumn("_k", F.first("k").over(Window.partitionBy(*key).orderBy("_from")))
    d = F.col("k") - F.col("_k")
    agg = fine.groupBy(*key).agg(
        F.sum("count").alias("n"), F.sum("sum").alias("s"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.max_by("last", F.struct("last_ts", -F.col("_from"))).alias("last"), F.max("last_ts").alias("last_ts"), F.min("_k").alias("k"),
        F.sum(F.col("k_sum") + F.col("count") * d).alias("ks"), F.sum(F.col("k_sum_2") + 2 * d * F.col("k_sum") + F.col("count") * d * d).alias("ks2"),
        F.count("k").alias("_with_k"), F.count(F.lit(1)).alias("_rows"))
    every = F.col("_with_k") == F.col("_rows")
    n, ks, ks2 = F.col("n"), F.col("ks"), F.col("ks2")
    out = agg.select(*key, n.alias("count"), F.col("s").alias("sum"), "min", "max", (F.col("s") / n).alias("mean"), "last", "last_ts",
                     F.when(every, F.col("k")).alias("k"), F.when(every, ks).alias("k_sum"), F.when(every, ks2).alias("k_sum_2"),
                     F.when(every, F.sqrt(F.greatest((ks2 - ks * ks / n) / n, F.lit(0.0)))).alias("std"))
    return with_keys(out).select(*OUTPUT_COLUMNS)
