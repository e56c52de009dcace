"""Upsert of emissions into target rows (read-compare-write rules, as one set operation).

Per key (minutes, object_id, date, timestamp), emissions apply in order to the stored row:

  stored row | emission | action
  -----------+----------+------------------------------------------------------------
  yes        | late     | merge the single value in (count, sum, min, max, last, k sums)
  yes        | closed   | replace if stored.count < closed.count, else keep (skip)
  no         | late     | insert the single-record row
  no         | closed   | insert

The rules are order dependent but a run of late records between two closed emissions
folds associatively, so the order is kept only at segment level: emissions carry a
``phase`` (even = run of late records number phase/2, odd = closed emission), each late
run is reduced with a partial aggregate (count, sum, min, max, last, first value,
mean, M2), and the short per-key list of segments (2 x closed emissions + 1 entries, not
the records) is folded in phase order with ``F.aggregate``.

``merge="combine"`` merges closed windows into stored rows exactly (no loss) by adding
shifted-variance states; it is only idempotent together with batch-id bookkeeping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clockroll.operators.aggregate import OUTPUT_COLUMNS

KEY = ["minutes", "object_id", "date", "timestamp"]
ACTION_COLUMNS = ["rec_normal", "rec_late", "rec_late_first", "rec_late_update",
                  "rec_override", "rec_skip"]

_STATE_FIELDS = [("present", "boolean"), ("count", "long"), ("sum", "double"),
                 ("min", "double"), ("max", "double"), ("mean", "double"), ("last", "double"),
                 ("last_ts", "long"), ("k", "double"), ("k_sum", "double"),
                 ("k_sum_2", "double"), ("std", "double"),
                 ("rec_normal", "long"), ("rec_late_first", "long"),
                 ("rec_late_update", "long"), ("rec_override", "long"), ("rec_skip", "long")]
_STATE_TYPE = "struct<" + ",".join(f"{n}:{t}" for n, t in _STATE_FIELDS) + ">"


def _segments(emitted: DataFrame) -> DataFrame:
    """One row per (key, phase): late runs reduced, closed emissions kept as they are."""
    lates = (emitted.filter(F.col("kind") == "late")
             .groupBy(*KEY, "phase")
             .agg(F.count(F.lit(1)).alias("count"), F.sum("sum").alias("sum"),
                  F.min("min").alias("min"), F.max("max").alias("max"),
                  F.max("last_ts").alias("last_ts"),
                  F.max_by("last", F.struct(F.col("last_ts"), -F.col("arr_major"),
                                            -F.col("arr_minor"))).alias("last"),
                  F.min_by("sum", F.struct("arr_major", "arr_minor")).alias("k"),
                  F.min_by(F.col("k").isNotNull(), F.struct("arr_major", "arr_minor")).alias("adv"),
                  F.var_pop("sum").alias("var"))
             .select(*KEY, "phase", F.lit(True).alias("is_late"), "count", "sum", "min", "max",
                     (F.col("sum") / F.col("count")).alias("mean"), "last", "last_ts",
                     F.when(F.col("adv"), F.col("k")).alias("k"),
                     F.lit(None).cast("double").alias("k_sum"),
                     F.lit(None).cast("double").alias("k_sum_2"),
                     F.lit(None).cast("double").alias("std"),
                     F.col("var")))
    closed = (emitted.filter(F.col("kind") == "closed")
              .select(*KEY, "phase", F.lit(False).alias("is_late"),
                      F.col("count").cast("long").alias("count"), "sum", "min", "max", "mean",
                      "last", F.col("last_ts").cast("long").alias("last_ts"), "k", "k_sum",
                      "k_sum_2", "std", F.lit(None).cast("double").alias("var")))
    return lates.unionByName(closed)


def _std(count: Column, k_sum: Column, k_sum_2: Column) -> Column:
    var = (k_sum_2 - k_sum * k_sum / count) / count
    return F.sqrt(F.greatest(var, F.lit(0.0)))


def _late_into(s: Column, x: Column) -> Column:
    """Fold a reduced late run ``x`` into state ``s``."""
    n = x["count"]
    # empty state: the first record is inserted, the others merge into it
    k0 = x["k"]
    d0 = x["mean"] - k0
    fresh = F.struct(
        F.lit(True).alias("present"), n.alias("count"), x["sum"].alias("sum"),
        x["min"].alias("min"), x["max"].alias("max"), x["mean"].alias("mean"),
        x["last"].alias("last"), x["last_ts"].alias("last_ts"), k0.alias("k"),
        F.when(k0.isNotNull(), n * d0).alias("k_sum"),
        F.when(k0.isNotNull(), x["var"] * n + n * d0 * d0).alias("k_sum_2"),
        F.when(k0.isNotNull(), F.sqrt(F.greatest(x["var"], F.lit(0.0)))).alias("std"),
        s["rec_normal"].alias("rec_normal"), (s["rec_late_first"] + 1).alias("rec_late_first"),
        (s["rec_late_update"] + n - 1).alias("rec_late_update"),
        s["rec_override"].alias("rec_override"), s["rec_skip"].alias("rec_skip"))
    cnt = s["count"] + n
    total = s["sum"] + x["sum"]
    has_k = s["k"].isNotNull()
    d = x["mean"] - s["k"]
    ks = F.when(has_k, s["k_sum"] + n * d)
    ks2 = F.when(has_k, s["k_sum_2"] + x["var"] * n + n * d * d)
    newer = s["last_ts"] < x["last_ts"]
    merged = F.struct(
        F.lit(True).alias("present"), cnt.alias("count"), total.alias("sum"),
        F.least(s["min"], x["min"]).alias("min"), F.greatest(s["max"], x["max"]).alias("max"),
        (total / cnt).alias("mean"),
        F.when(newer, x["last"]).otherwise(s["last"]).alias("last"),
        F.when(newer, x["last_ts"]).otherwise(s["last_ts"]).alias("last_ts"),
        s["k"].alias("k"), ks.alias("k_sum"), ks2.alias("k_sum_2"),
        F.when(has_k, _std(cnt, ks, ks2)).alias("std"),
        s["rec_normal"].alias("rec_normal"), s["rec_late_first"].alias("rec_late_first"),
        (s["rec_late_update"] + n).alias("rec_late_update"),
        s["rec_override"].alias("rec_override"), s["rec_skip"].alias("rec_skip"))
    return F.when(s["present"], merged).otherwise(fresh)


def _row_of(x: Column, s: Column, normal, override, skip) -> Column:
    return F.struct(
        F.lit(True).alias("present"), x["count"].alias("count"), x["sum"].alias("sum"),
        x["min"].alias("min"), x["max"].alias("max"), x["mean"].alias("mean"),
        x["last"].alias("last"), x["last_ts"].alias("last_ts"), x["k"].alias("k"),
        x["k_sum"].alias("k_sum"), x["k_sum_2"].alias("k_sum_2"), x["std"].alias("std"),
        (s["rec_normal"] + normal).alias("rec_normal"), s["rec_late_first"].alias("rec_late_first"),
        s["rec_late_update"].alias("rec_late_update"),
        (s["rec_override"] + override).alias("rec_override"), (s["rec_skip"] + skip).alias("rec_skip"))


def _keep(s: Column, skip) -> Column:
    return F.struct(*[(s[n] + skip).alias(n) if n == "rec_skip" else s[n].alias(n)
                      for n, _ in _STATE_FIELDS])


def _closed_parity(s: Column, x: Column) -> Column:
    return (F.when(~s["present"], _row_of(x, s, 1, 0, 0))
            .when(s["count"] < x["count"], _row_of(x, s, 0, 1, 0))
            .otherwise(_keep(s, 1)))


def _closed_combine(s: Column, x: Column) -> Column:
    cnt = s["count"] + x["count"]
    total = s["sum"] + x["sum"]
    both_k = s["k"].isNotNull() & x["k"].isNotNull()
    d = x["k"] - s["k"]
    ks = F.when(both_k, s["k_sum"] + x["k_sum"] + x["count"] * d)
    ks2 = F.when(both_k, s["k_sum_2"] + x["k_sum_2"] + F.lit(2.0) * d * x["k_sum"]
                 + x["count"] * d * d)
    newer = s["last_ts"] < x["last_ts"]
    merged = F.struct(
        F.lit(True).alias("present"), cnt.alias("count"), total.alias("sum"),
        F.least(s["min"], x["min"]).alias("min"), F.greatest(s["max"], x["max"]).alias("max"),
        (total / cnt).alias("mean"),
        F.when(newer, x["last"]).otherwise(s["last"]).alias("last"),
        F.when(newer, x["last_ts"]).otherwise(s["last_ts"]).alias("last_ts"),
        F.when(both_k, s["k"]).alias("k"), ks.alias("k_sum"), ks2.alias("k_sum_2"),
        F.when(both_k, _std(cnt, ks, ks2)).alias("std"),
        s["rec_normal"].alias("rec_normal"), s["rec_late_first"].alias("rec_late_first"),
        s["rec_late_update"].alias("rec_late_update"),
        (s["rec_override"] + 1).alias("rec_override"), s["rec_skip"].alias("rec_skip"))
    return F.when(~s["present"], _row_of(x, s, 1, 0, 0)).otherwise(merged)


def _initial_state(existing_alias: str = "_e") -> Column:
    e = F.col(existing_alias)
    present = e.isNotNull()
    zero = F.lit(0).cast("long")
    return F.struct(
        present.alias("present"), e["count"].cast("long").alias("count"),
        e["sum"].cast("double").alias("sum"), e["min"].cast("double").alias("min"),
        e["max"].cast("double").alias("max"), e["mean"].cast("double").alias("mean"),
        e["last"].cast("double").alias("last"), e["last_ts"].cast("long").alias("last_ts"),
        e["k"].cast("double").alias("k"), e["k_sum"].cast("double").alias("k_sum"),
        e["k_sum_2"].cast("double").alias("k_sum_2"), e["std"].cast("double").alias("std"),
        zero.alias("rec_normal"), zero.alias("rec_late_first"), zero.alias("rec_late_update"),
        zero.alias("rec_override"), zero.alias("rec_skip")).cast(_STATE_TYPE)


def _fold(existing: DataFrame, emitted: DataFrame, mode: str) -> DataFrame:
    segs = _segments(emitted)
    seg_struct = F.struct(*[F.col(c) for c in segs.columns if c not in KEY])
    per_key = segs.groupBy(*KEY).agg(F.array_sort(F.collect_list(seg_struct)).alias("_segs"))
    stat_cols = [c for c in OUTPUT_COLUMNS if c not in KEY]
    ex = existing.select(*KEY, F.struct(*stat_cols).alias("_e"))
    joined = per_key.join(ex, KEY, "left")
    closed_rule = _closed_parity if mode == "parity" else _closed_combine
    final = F.aggregate(
        "_segs", _initial_state(),
        lambda s, x: F.when(x["is_late"], _late_into(s, x)).otherwise(closed_rule(s, x)))
    return joined.select(*KEY, final.alias("_s"))


def _split(folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = folded.select(*KEY, *[F.col("_s")[c].alias(c)
                                 for c in OUTPUT_COLUMNS if c not in KEY])
    actions = folded.select(
        *KEY, F.col("_s.rec_normal").alias("rec_normal"),
        (F.col("_s.rec_late_first") + F.col("_s.rec_late_update")).alias("rec_late"),
        F.col("_s.rec_late_first").alias("rec_late_first"),
        F.col("_s.rec_late_update").alias("rec_late_update"),
        F.col("_s.rec_override").alias("rec_override"), F.col("_s.rec_skip").alias("rec_skip"))
    return rows.select(*OUTPUT_COLUMNS), actions


def upsert(existing: DataFrame, emitted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parity rules.  Returns (new rows of every touched key, per-key action counters)."""
    return _split(_fold(existing, emitted, "parity"))


def upsert_combine(existing: DataFrame, emitted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact merge: closed windows are added to stored rows instead of replacing them."""
    return _split(_fold(existing, emitted, "combine"))


def action_totals(actions: DataFrame) -> DataFrame:
    return actions.agg(*[F.sum(c).cast("long").alias(c) for c in ACTION_COLUMNS])
