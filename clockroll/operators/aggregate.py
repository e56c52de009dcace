"""Window statistics (count, sum, min, max, mean, last, k-state, population std).

One ``groupBy`` with partial (map-side) aggregation: every statistic is expressed as a
mergeable aggregate, so a hot (object, window) is combined before the shuffle.

The shifted-variance state of the target row (k = first value by arrival,
k_sum = sum(v-k), k_sum_2 = sum((v-k)^2)) is derived from stable moments:
k_sum = n(mean-k) and k_sum_2 = M2 + n(mean-k)^2, with M2 = n*var_pop from Spark's
central-moment aggregate (no cancellation, no second pass over the rows).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clockroll.functions.timefn import date_key, ntz_from_ms, window_start_ms
from clockroll.functions.units import ADVANCED_UNITS, with_stdev

OUTPUT_COLUMNS = ["minutes", "object_id", "date", "timestamp", "count", "sum", "min", "max",
                  "mean", "last", "last_ts", "k", "k_sum", "k_sum_2", "std"]
STAT_COLUMNS = OUTPUT_COLUMNS[4:]


def arrival() -> Column:
    return F.struct(F.col("arr_major"), F.col("arr_minor"))


def last_order() -> Column:
    """Greatest timestamp wins; on equal timestamps the first arrived wins."""
    return F.struct(F.col("ts_ms"), -F.col("arr_major"), -F.col("arr_minor"))


def stats_aggs(advanced=ADVANCED_UNITS) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_n"),
        F.sum("value").alias("_sum"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
        F.max("ts_ms").alias("_last_ts"),
        F.max_by("value", last_order()).alias("_last"),
        F.min_by("value", arrival()).alias("_k"),
        F.min_by(with_stdev(F.col("unit"), advanced), arrival()).alias("_adv"),
        F.var_pop("value").alias("_var"),
    ]


def finalize_stats(df: DataFrame) -> DataFrame:
    """Turn the ``stats_aggs`` buffers into the target columns (NULL = not computed)."""
    n = F.col("_n")
    mean = F.col("_sum") / n
    adv = F.col("_adv")
    dk = mean - F.col("_k")
    return (df
            .withColumn("count", n)
            .withColumn("sum", F.col("_sum"))
            .withColumn("min", F.col("_min"))
            .withColumn("max", F.col("_max"))
            .withColumn("mean", mean)
            # last starts at (0, ts 0): a timestamp at or before the epoch never replaces it
            .withColumn("last", F.when(F.col("_last_ts") > 0, F.col("_last")).otherwise(F.lit(0.0)))
            .withColumn("last_ts", F.greatest(F.col("_last_ts"), F.lit(0).cast("long")))
            .withColumn("k", F.when(adv, F.col("_k")))
            .withColumn("k_sum", F.when(adv, n * dk))
            .withColumn("k_sum_2", F.when(adv, F.col("_var") * n + n * dk * dk))
            .withColumn("std", F.when(adv, F.sqrt(F.greatest(F.col("_var"), F.lit(0.0)))))
            .drop("_n", "_sum", "_min", "_max", "_last_ts", "_last", "_k", "_adv", "_var"))


def with_keys(df: DataFrame, minutes_col: str = "minutes", ws_col: str = "ws_ms") -> DataFrame:
    """Add ``date`` and ``timestamp`` (window start as TIMESTAMP_NTZ, UTC wall time)."""
    mins = F.col(minutes_col)
    # the date key layout depends on the granularity; granularity is a column here
    dk_month = date_key(F.col(ws_col), 60)
    dk_half = date_key(F.col(ws_col), 61)
    return (df.withColumn("date", F.when(mins <= 60, dk_month).otherwise(dk_half))
              .withColumn("timestamp", ntz_from_ms(F.col(ws_col))))


def rollup(measures: DataFrame, minutes: int, align: str = "hour",
           advanced=ADVANCED_UNITS) -> DataFrame:
    """Per (object, window) statistics over all given measures (no lateness)."""
    return rollup_many(measures, [minutes], align=align, advanced=advanced)


def rollup_many(measures: DataFrame, granularities: Iterable[int], align: str = "hour",
                advanced=ADVANCED_UNITS) -> DataFrame:
    """Several granularities in one scan and one shuffle: each measure is expanded to one
    (minutes, window) pair per granularity before the partial aggregation."""
    gs = sorted(set(int(g) for g in granularities))
    if not gs:
        raise ValueError("no granularity")
    if len(gs) == 1:
        keyed = measures.select("*", F.lit(gs[0]).alias("minutes"),
                                window_start_ms(F.col("ts_ms"), gs[0], align).alias("ws_ms"))
    else:
        pairs = F.array(*[F.struct(F.lit(g).alias("minutes"),
                                   window_start_ms(F.col("ts_ms"), g, align).alias("ws_ms"))
                          for g in gs])
        keyed = (measures.select("*", F.explode(pairs).alias("_g"))
                 .select("*", F.col("_g.minutes").alias("minutes"), F.col("_g.ws_ms").alias("ws_ms"))
                 .drop("_g"))
    agg = keyed.groupBy("minutes", "object_id", "ws_ms").agg(*stats_aggs(advanced))
    return with_keys(finalize_stats(agg)).select(*OUTPUT_COLUMNS)
