"""Registered queries over the driver tables, and the matching oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and always reads whole tables.  Doubles
are rounded to 6 digits in the registered outputs only (the library keeps full
precision) so engines that sum in a different order still compare equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.functions.timefn import date_key, format_ts, ntz_from_ms, window_start_ms
from clockroll.functions.units import is_target_unit, with_stdev
from clockroll.operators.aggregate import rollup, rollup_many, with_keys
from clockroll.operators.coarser import coarser
from clockroll.operators.lateness import (EMISSION_COLUMNS, classify_arrivals, emissions, emissions_many,
                                          object_clock, open_windows_at_end)
from clockroll.operators.merge import ACTION_COLUMNS, action_totals, upsert, upsert_combine
from clockroll.plans import oracle as O
from clockroll.session import ensure_utc
from clockroll.sources.measures import (events_as_json, malformed_json, measures_from_events,
                                        measures_from_lineitem, parse_measures, read_json_measures, valid_measures)

DOUBLE_COLS = {"sum", "min", "max", "mean", "last", "k", "k_sum", "k_sum_2", "std", "value"}


def _r6(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.name in DOUBLE_COLS and f.dataType.typeName() == "double":
            r = F.round(F.col(f.name), 6)
            out.append(F.when(r == 0, F.lit(0.0)).otherwise(r).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _target(m: DataFrame) -> DataFrame:
    return m.filter(is_target_unit(F.col("unit")))


def sparse(spark, sf_dir):
    return _target(measures_from_events(table(spark, sf_dir, "events"), "sparse",
                                        targets_only=True))


def dense(spark, sf_dir):
    return _target(measures_from_events(table(spark, sf_dir, "events"), "dense",
                                        targets_only=True))


def lineitem(spark, sf_dir):
    return measures_from_lineitem(table(spark, sf_dir, "lineitem"))


DENSE_LATE = RollupConfig(granularity=60, allowed_lateness=30, flush_every=0)
SPARSE_LATE = RollupConfig(granularity=15, allowed_lateness=5, flush_every=0)
LINEITEM_LATE = RollupConfig(granularity=1440, allowed_lateness=1440, flush_every=0,
                             align="epoch")


# ---------------------------------------------------------------------------
# parsing / filtering / scalar functions
# ---------------------------------------------------------------------------

def q_parse_valid(spark, sf_dir):
    parsed = parse_measures(events_as_json(table(spark, sf_dir, "events")))
    return _r6(valid_measures(parsed))


def q_parse_reject_reasons(spark, sf_dir):
    parsed = parse_measures(events_as_json(table(spark, sf_dir, "events")))
    return (parsed.filter(F.col("reason").isNotNull()).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n")))


def q_unit_filter(spark, sf_dir):
    m = measures_from_events(table(spark, sf_dir, "events"), "sparse")
    return (m.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
            .select("unit", is_target_unit(F.col("unit")).alias("is_target"),
                    with_stdev(F.col("unit")).alias("with_std"), "n"))


def _window_start_query(g):
    def q(spark, sf_dir):
        m = measures_from_events(table(spark, sf_dir, "events"), "sparse")
        ws = window_start_ms(F.col("ts_ms"), g)
        return m.select(F.col("arr_minor").alias("event_id"), "ts_ms", ws.alias("ws_ms"),
                        ntz_from_ms(ws).alias("window_start"))
    return q


def q_format_window_start(spark, sf_dir):
    m = lineitem(spark, sf_dir)
    ws = window_start_ms(F.col("ts_ms"), 15)
    return (m.select(format_ts(ws).alias("window_start")).groupBy("window_start")
            .agg(F.count(F.lit(1)).alias("n")))


def _date_key_query(g):
    def q(spark, sf_dir):
        m = lineitem(spark, sf_dir)
        ws = window_start_ms(F.col("ts_ms"), g)
        return (m.select(date_key(ws, g).alias("date")).groupBy("date")
                .agg(F.count(F.lit(1)).alias("n")))
    return q


# ---------------------------------------------------------------------------
# rollups
# ---------------------------------------------------------------------------

def q_rollup_15m(spark, sf_dir):
    return _r6(rollup(dense(spark, sf_dir), 15))


def q_rollup_60m(spark, sf_dir):
    return _r6(rollup(dense(spark, sf_dir), 60))


def q_rollup_multi_granularity(spark, sf_dir):
    return _r6(rollup_many(dense(spark, sf_dir), [15, 60, 1440]))


def q_rollup_last_tie(spark, sf_dir):
    r = rollup(lineitem(spark, sf_dir), 60)
    return _r6(r.select("minutes", "object_id", "date", "timestamp", "count", "last", "last_ts"))


def q_rollup_kstate(spark, sf_dir):
    r = rollup(dense(spark, sf_dir), 60)
    return _r6(r.select("minutes", "object_id", "date", "timestamp", "count", "k", "k_sum",
                        "k_sum_2", "std"))


def q_rollup_basic_vs_advanced(spark, sf_dir):
    return _r6(rollup(sparse(spark, sf_dir), 60))


def q_rollup_epoch_align_daily(spark, sf_dir):
    return _r6(rollup(lineitem(spark, sf_dir), 1440, align="epoch"))


def q_rollup_json_60m(spark, sf_dir):
    parsed = parse_measures(events_as_json(table(spark, sf_dir, "events")))
    return _r6(rollup(valid_measures(parsed), 60))


# ---------------------------------------------------------------------------
# per-object clock, lateness, emissions
# ---------------------------------------------------------------------------

def q_time_advance(spark, sf_dir):
    return object_clock(sparse(spark, sf_dir))


def q_classify_arrivals(spark, sf_dir):
    c = classify_arrivals(dense(spark, sf_dir), DENSE_LATE)
    return c.select("object_id", "arr_major", "arr_minor", "ts_ms", "ws_ms", "ta_ms", "status")


def q_classify_sparse(spark, sf_dir):
    c = classify_arrivals(sparse(spark, sf_dir), SPARSE_LATE)
    return c.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _lateness_summary_query(g, lat, mapping="dense"):
    """Counts per fate plus closed / still-open windows for one configuration."""
    cfg = RollupConfig(granularity=g, allowed_lateness=lat, flush_every=0)

    def q(spark, sf_dir):
        m = dense(spark, sf_dir) if mapping == "dense" else sparse(spark, sf_dir)
        c = classify_arrivals(m, cfg)
        fates = c.groupBy(F.col("status").alias("metric")).agg(F.count(F.lit(1)).alias("n"))
        clock = c.groupBy("object_id").agg(F.max("ts_ms").alias("_fta"))
        wins = (c.filter(F.col("status") != "late").select("object_id", "ws_ms").distinct()
                .join(clock, "object_id")
                .select(F.when(F.col("ws_ms") <= F.col("_fta") - F.lit(cfg.size_ms + cfg.lateness_ms),
                               "closed_windows").otherwise("open_windows").alias("metric"))
                .groupBy("metric").agg(F.count(F.lit(1)).alias("n")))
        return fates.unionByName(wins)
    return q


def q_emissions_flush0(spark, sf_dir):
    return _r6(emissions(dense(spark, sf_dir), DENSE_LATE).select(*EMISSION_COLUMNS))


def q_open_windows_at_end(spark, sf_dir):
    return _r6(open_windows_at_end(dense(spark, sf_dir), DENSE_LATE))


def q_flush_at_end(spark, sf_dir):
    return _r6(emissions(dense(spark, sf_dir), DENSE_LATE, flush_at_end=True)
               .select(*EMISSION_COLUMNS))


MULTI_LATE = [RollupConfig(granularity=15, allowed_lateness=5, flush_every=0),
              DENSE_LATE,
              RollupConfig(granularity=1440, allowed_lateness=60, flush_every=0)]


def q_emissions_multi_granularity(spark, sf_dir):
    return _r6(emissions_many(dense(spark, sf_dir), MULTI_LATE).select(*EMISSION_COLUMNS))


def q_upsert_multi_granularity(spark, sf_dir):
    rows, _ = upsert(_empty_target(spark), emissions_many(dense(spark, sf_dir), MULTI_LATE))
    return _r6(rows)


def _empty_target(spark) -> DataFrame:
    from clockroll.sources.target import TARGET_SCHEMA
    return spark.createDataFrame([], TARGET_SCHEMA)


def q_upsert_actions(spark, sf_dir):
    em = emissions(dense(spark, sf_dir), DENSE_LATE)
    _, actions = upsert(_empty_target(spark), em)
    return action_totals(actions)


def q_upsert_final_parity(spark, sf_dir):
    em = emissions(dense(spark, sf_dir), DENSE_LATE)
    rows, _ = upsert(_empty_target(spark), em)
    return _r6(rows)


def q_upsert_final_combine(spark, sf_dir):
    em = emissions(dense(spark, sf_dir), DENSE_LATE)
    rows, _ = upsert_combine(_empty_target(spark), em)
    return _r6(rows)


def q_lineitem_daily_by_supplier(spark, sf_dir):
    em = emissions(lineitem(spark, sf_dir), LINEITEM_LATE)
    rows, _ = upsert(_empty_target(spark), em)
    return _r6(rows)


def q_parse_bad_input(spark, sf_dir):
    """Every record with its fate: the reason it was rejected, or its parsed fields."""
    parsed = parse_measures(malformed_json(table(spark, sf_dir, "events")))
    good = F.col("reason").isNull()
    return _r6(parsed.select(F.col("arr_minor").alias("event_id"), "reason", F.when(good, F.col("object_id")).alias("object_id"),
                             F.when(good, F.col("ts_ms")).alias("ts_ms"), F.when(good, F.col("value")).alias("value")))


def q_history_arrival_index(spark, sf_dir):
    """The measures as a JSON history of many files, read back: every record with its exact place."""
    from clockroll.session import scratch_dir
    path = scratch_dir(spark, "history") + "/json"
    lines = events_as_json(table(spark, sf_dir, "events"))
    lines.repartitionByRange(16, "arr_major", "arr_minor").sortWithinPartitions("arr_major", "arr_minor").select("value").write.text(path)
    parsed = read_json_measures(spark, path)
    return _r6(parsed.select("object_id", "unit", "ts_ms", "value", (F.col("arr_major") + F.col("arr_minor")).alias("place"), "reason"))


CADENCE = RollupConfig(granularity=60, allowed_lateness=30)  # flush_every default 2


def q_emissions_cadence(spark, sf_dir):
    return _r6(emissions(dense(spark, sf_dir), CADENCE).select(*EMISSION_COLUMNS))


IDLE = RollupConfig(granularity=15, allowed_lateness=5, timeout=20, flush_every=0)


def q_emissions_idle_timeout(spark, sf_dir):
    """Objects that pause for 20 minutes have their windows closed; records that follow open them again."""
    return _r6(emissions(dense(spark, sf_dir), IDLE, idle_timeout=True).select(*EMISSION_COLUMNS))


def q_upsert_recreated_windows(spark, sf_dir):
    rows, _ = upsert(_empty_target(spark), emissions(dense(spark, sf_dir), IDLE, idle_timeout=True))
    return _r6(rows)


def q_upsert_recreated_windows_actions(spark, sf_dir):
    """The same emissions by action: windows opened again are overridden or skipped."""
    _, actions = upsert(_empty_target(spark), emissions(dense(spark, sf_dir), IDLE, idle_timeout=True))
    return action_totals(actions)


def _halves(spark, sf_dir):
    """The dense measures in two halves by event id, each with its own emissions: the second one
    meets stored rows of the first."""
    m = dense(spark, sf_dir)
    return [emissions(m.where(F.pmod("arr_minor", F.lit(2)) == i), DENSE_LATE) for i in (0, 1)]


def _stored(spark, sf_dir):
    from clockroll.session import scratch_dir
    from clockroll.sources.target import RollupTable
    t = RollupTable(spark, scratch_dir(spark, "upsert-stored"))
    return t, [t.apply(em, i) for i, em in enumerate(_halves(spark, sf_dir))]


def q_upsert_onto_stored(spark, sf_dir):
    return _r6(_stored(spark, sf_dir)[0].read())


def q_upsert_onto_stored_actions(spark, sf_dir):
    acts = _stored(spark, sf_dir)[1]
    rows = [(i, *[a[c] for c in ACTION_COLUMNS]) for i, a in enumerate(acts)]
    return spark.createDataFrame(rows, "batch int, " + ", ".join(f"{c} long" for c in ACTION_COLUMNS))


def q_rollup_daily_from_15m(spark, sf_dir):
    """Daily windows from the rows of 15-minute windows."""
    # sums in another order differ in their last bits; means are taken from sums rounded alike
    rows = coarser(rollup(dense(spark, sf_dir), 15), 1440)
    return _r6(rows.withColumn("mean", F.round("sum", 6) / F.col("count")))


def q_target_read_by_keys(spark, sf_dir):
    """A stored table read by the keys of the hour after each measure: some have a row, others not."""
    t, _ = _stored(spark, sf_dir)
    g = DENSE_LATE.granularity
    after = window_start_ms(F.col("ts_ms"), g) + g * 60_000
    keys = with_keys(dense(spark, sf_dir).select(F.lit(g).alias("minutes"), "object_id", after.alias("ws_ms")).distinct())
    return _r6(t.read_keys(keys))


def q_stream_multi_granularity(spark, sf_dir):
    """Three granularities in one stream over 3 slices: one source, one state, one checkpoint."""
    from clockroll.streaming.job import replay_emissions
    return _r6(replay_emissions(spark, dense(spark, sf_dir), MULTI_LATE, slices=3))


def q_stream_rollup(spark, sf_dir):
    from clockroll.streaming.job import replay_to_table
    # three arrival slices, one micro-batch each: the state crosses batch boundaries
    return _r6(replay_to_table(spark, dense(spark, sf_dir), DENSE_LATE, slices=3).read())


def q_stream_emissions_cadence(spark, sf_dir):
    from clockroll.streaming.job import replay_emissions
    return _r6(replay_emissions(spark, dense(spark, sf_dir), CADENCE, slices=3))


QUERIES = {
    "parse_valid": q_parse_valid,
    "parse_reject_reasons": q_parse_reject_reasons,
    "unit_filter": q_unit_filter,
    "window_start_15": _window_start_query(15),
    "window_start_25": _window_start_query(25),
    "window_start_1440": _window_start_query(1440),
    "format_window_start": q_format_window_start,
    "date_key_month": _date_key_query(60),
    "date_key_halfyear": _date_key_query(1440),
    "rollup_15m": q_rollup_15m,
    "rollup_60m": q_rollup_60m,
    "rollup_multi_granularity": q_rollup_multi_granularity,
    "rollup_last_tie": q_rollup_last_tie,
    "rollup_kstate": q_rollup_kstate,
    "rollup_basic_vs_advanced": q_rollup_basic_vs_advanced,
    "rollup_epoch_align_daily": q_rollup_epoch_align_daily,
    "rollup_json_60m": q_rollup_json_60m,
    "time_advance": q_time_advance,
    "classify_arrivals": q_classify_arrivals,
    "classify_sparse": q_classify_sparse,
    "lateness_dense_15_5": _lateness_summary_query(15, 5),
    "lateness_dense_25_5": _lateness_summary_query(25, 5),
    "lateness_dense_60_0": _lateness_summary_query(60, 0),
    "lateness_dense_1440_0": _lateness_summary_query(1440, 0),
    "emissions_flush0": q_emissions_flush0,
    "open_windows_at_end": q_open_windows_at_end,
    "emissions_multi_granularity": q_emissions_multi_granularity,
    "upsert_multi_granularity": q_upsert_multi_granularity,
    "flush_at_end": q_flush_at_end,
    "upsert_actions": q_upsert_actions,
    "upsert_final_parity": q_upsert_final_parity,
    "upsert_final_combine": q_upsert_final_combine,
    "lineitem_daily_by_supplier": q_lineitem_daily_by_supplier,
    "parse_bad_input": q_parse_bad_input,
    "history_arrival_index": q_history_arrival_index,
    "emissions_cadence": q_emissions_cadence,
    "emissions_idle_timeout": q_emissions_idle_timeout,
    "upsert_recreated_windows": q_upsert_recreated_windows,
    "upsert_recreated_windows_actions": q_upsert_recreated_windows_actions,
    "upsert_onto_stored": q_upsert_onto_stored,
    "upsert_onto_stored_actions": q_upsert_onto_stored_actions,
    "rollup_daily_from_15m": q_rollup_daily_from_15m,
    "target_read_by_keys": q_target_read_by_keys,
    "stream_multi_granularity": q_stream_multi_granularity,
    "stream_rollup": q_stream_rollup,
    "stream_emissions_cadence": q_stream_emissions_cadence,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_upsert_final_parity(spark, sf_dir)


# ---------------------------------------------------------------------------
# oracle SQL
# ---------------------------------------------------------------------------

def _sql_window_start(g):
    return f"""SELECT arr_minor AS event_id, ts_ms, {O.ws(g)} AS ws_ms,
  make_timestamp({O.ws(g)} * 1000) AS window_start FROM ({O.events_sparse()}) q"""


def _sql_date_key(g):
    return f"""SELECT {O.date_key(g, O.ws(g))} AS date, count(*) AS n
FROM ({O.lineitem_measures()}) q GROUP BY 1"""


def _sql_rollup_cols(sql: str, cols: list[str]) -> str:
    quoted = ", ".join(f'"{c}"' for c in cols)
    return f"SELECT {quoted} FROM ({sql}) r"


def _sql_emissions(flush_at_end: bool, g: int = DENSE_LATE.granularity,
                   lat: int = DENSE_LATE.allowed_lateness) -> str:
    return f"""WITH {O.emissions_cte(O.events_dense(), g, lat, flush_at_end)}
SELECT minutes, object_id, {O.date_key(g)} AS date, {O.ts_of()} AS "timestamp",
  n AS "count", {O.r6('s')} AS "sum", {O.r6('mn')} AS "min", {O.r6('mx')} AS "max",
  {O.r6('s / n')} AS mean, {O.r6('CASE WHEN lts > 0 THEN lst ELSE 0.0 END')} AS "last",
  greatest(lts, 0) AS last_ts, {O.r6('CASE WHEN adv THEN k0 END')} AS k,
  {O.r6('CASE WHEN adv THEN ks END')} AS k_sum, {O.r6('CASE WHEN adv THEN ks2 END')} AS k_sum_2,
  {O.r6('CASE WHEN adv THEN sqrt(greatest((ks2 - ks * ks / n) / n, 0.0)) END')} AS std,
  kind, phase, arr_major, arr_minor
FROM em"""


def _sql_upsert_actions() -> str:
    g, lat = DENSE_LATE.granularity, DENSE_LATE.allowed_lateness
    return f"""WITH {O.emissions_cte(O.events_dense(), g, lat)},
per AS (SELECT object_id, ws_ms,
          count(*) FILTER (WHERE kind = 'late' AND phase = 0) AS b,
          count(*) FILTER (WHERE kind = 'closed') AS c,
          count(*) FILTER (WHERE kind = 'late' AND phase = 2) AS a,
          max(n) FILTER (WHERE kind = 'closed') AS cn
        FROM em GROUP BY object_id, ws_ms)
SELECT
  CAST(sum(CASE WHEN c = 1 AND b = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rec_normal,
  CAST(sum(b + a) AS BIGINT) AS rec_late,
  CAST(sum(CASE WHEN b > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rec_late_first,
  CAST(sum(b + a - CASE WHEN b > 0 THEN 1 ELSE 0 END) AS BIGINT) AS rec_late_update,
  CAST(sum(CASE WHEN c = 1 AND b > 0 AND b < cn THEN 1 ELSE 0 END) AS BIGINT) AS rec_override,
  CAST(sum(CASE WHEN c = 1 AND b > 0 AND b >= cn THEN 1 ELSE 0 END) AS BIGINT) AS rec_skip
FROM per"""


def _sql_upsert_combine() -> str:
    """Combine = every emitted value of a key lands in the row once (exact merge)."""
    g, lat = DENSE_LATE.granularity, DENSE_LATE.allowed_lateness
    return f"""WITH {O.classify_cte(O.events_dense(), g, lat)},
fc AS (SELECT object_id, max(ts_ms) AS fta FROM cl GROUP BY object_id),
wins AS (SELECT DISTINCT object_id, ws_ms FROM cl WHERE status <> 'late'),
closedw AS (SELECT w.object_id, w.ws_ms FROM wins w JOIN fc USING (object_id)
            WHERE w.ws_ms <= fc.fta - {(g + lat) * 60000}),
x AS (SELECT cl.*, (cl.status <> 'late') AS in_window,
        (cw.object_id IS NOT NULL) AS win_closed FROM cl
      LEFT JOIN closedw cw USING (object_id, ws_ms)),
-- emitted values: closed windows' records plus every late record
ev AS (SELECT *, CASE WHEN in_window THEN 1 WHEN opened THEN 2 ELSE 0 END AS ph
       FROM x WHERE (in_window AND win_closed) OR status = 'late'),
ord AS (SELECT *, first_value(CASE WHEN ph = 1 THEN unit IN {O.ADV} ELSE unit IN {O.ADV} END)
          OVER (PARTITION BY object_id, ws_ms ORDER BY ph, arr_major, arr_minor) AS adv0,
        first_value(value) OVER (PARTITION BY object_id, ws_ms ORDER BY ph, arr_major, arr_minor) AS kf
        FROM ev),
st AS (SELECT {g} AS minutes, object_id, ws_ms, count(*) AS n, sum(value) AS s,
        min(value) AS mn, max(value) AS mx, max(ts_ms) AS lts,
        first(value ORDER BY ts_ms DESC, ph, arr_major, arr_minor) AS lst,
        bool_and(adv0) AS adv, min(kf) AS k0,
        sum(value - kf) AS ks, sum((value - kf) * (value - kf)) AS ks2
       FROM ord GROUP BY object_id, ws_ms)
SELECT {O.final_cols(g)} FROM st"""


def _sql_emission_rows(ctes: str, g: int) -> str:
    return f"""WITH RECURSIVE {ctes}
SELECT minutes, object_id, {O.date_key(g)} AS date, {O.ts_of()} AS "timestamp",
  n AS "count", {O.r6('s')} AS "sum", {O.r6('mn')} AS "min", {O.r6('mx')} AS "max",
  {O.r6('s / n')} AS mean, {O.r6('CASE WHEN lts > 0 THEN lst ELSE 0.0 END')} AS "last",
  greatest(lts, 0) AS last_ts, {O.r6('CASE WHEN adv THEN k0 END')} AS k,
  {O.r6('CASE WHEN adv THEN ks END')} AS k_sum, {O.r6('CASE WHEN adv THEN ks2 END')} AS k_sum_2,
  {O.r6('CASE WHEN adv THEN sqrt(greatest((ks2 - ks * ks / n) / n, 0.0)) END')} AS std,
  kind, phase, arr_major, arr_minor
FROM em"""


def _sql_cadence() -> str:
    c = CADENCE
    return _sql_emission_rows(O.cadence_cte(O.events_dense(), c.granularity, c.allowed_lateness, c.flush_every), c.granularity)


def _idle_cte() -> str:
    return O.idle_cte(O.events_dense(), IDLE.granularity, IDLE.allowed_lateness, IDLE.timeout)


def _sql_recreated(actions: bool) -> str:
    sql = O.applied_sql(f"SELECT 0 AS batch, * FROM (WITH {_idle_cte()} SELECT * FROM em)", IDLE.granularity, actions)
    return f"SELECT * EXCLUDE (batch) FROM ({sql})" if actions else sql


def _sql_bad_input() -> str:
    """The faults by ``event_id`` modulo 16 and the first reason that applies."""
    return f"""WITH e AS (SELECT *, arr_minor % 16 AS q, unit NOT IN {O.TARGET} AS foreign_unit FROM ({O.events_sparse(float32=True)}) z),
r AS (SELECT *, CASE WHEN q = 12 THEN 'bad_json' WHEN q IN (1, 2) THEN 'bad_timestamp' WHEN q IN (3, 4) THEN 'bad_object_id'
    WHEN q IN (5, 15) OR foreign_unit THEN 'unit' WHEN q IN (6, 7, 8, 13) THEN 'bad_value' WHEN q = 9 THEN 'nan'
    WHEN q = 10 THEN 'missing_object' WHEN q = 11 THEN 'missing_timestamp' END AS reason FROM e)
SELECT arr_minor AS event_id, reason, CASE WHEN reason IS NULL THEN object_id END AS object_id,
  CASE WHEN reason IS NULL THEN ts_ms END AS ts_ms, {O.r6('CASE WHEN reason IS NULL THEN value END')} AS value FROM r"""


def _sql_stored(actions: bool) -> str:
    return O.two_batches_sql(O.events_dense(), DENSE_LATE.granularity, DENSE_LATE.allowed_lateness, actions)


def _sql_coarser(fine: int, g: int) -> str:
    """As a rollup of the records, but ``k`` is the first value of the earliest fine window."""
    first = f"{O.ws(fine)}, {O.ARR}"
    return f"""WITH m AS (SELECT *, {O.ws(g, 'epoch')} AS ws_ms FROM ({O.events_dense()}) q WHERE unit IN {O.TARGET}),
f AS (SELECT *, first_value(value) OVER (PARTITION BY object_id, ws_ms ORDER BY {first}) AS kf FROM m),
st AS (SELECT {g} AS minutes, object_id, ws_ms, count(*) AS n, round(sum(value), 6) AS s, min(value) AS mn, max(value) AS mx, max(ts_ms) AS lts,
    first(value ORDER BY ts_ms DESC, {O.ARR}) AS lst, min(kf) AS k0, bool_and(unit IN {O.ADV}) AS adv,
    sum(value - kf) AS ks, sum((value - kf) * (value - kf)) AS ks2 FROM f GROUP BY object_id, ws_ms)
SELECT {O.final_cols(g)} FROM st"""


def _sql_read_by_keys() -> str:
    g = DENSE_LATE.granularity
    stats = ", ".join(f't."{c}"' for c in ("count", "sum", "min", "max", "mean", "last", "last_ts", "k", "k_sum", "k_sum_2", "std"))
    return f"""WITH keys AS (SELECT DISTINCT {g} AS minutes, object_id, {O.ws(g)} + {g * 60000} AS ws_ms FROM ({O.events_dense()}) q WHERE unit IN {O.TARGET}),
named AS (SELECT minutes, object_id, {O.date_key(g)} AS date, {O.ts_of()} AS "timestamp" FROM keys)
SELECT k.minutes, k.object_id, k.date, k."timestamp", {stats} FROM named k LEFT JOIN ({_sql_stored(actions=False)}) t
  ON t.minutes = k.minutes AND t.object_id = k.object_id AND t.date = k.date AND k."timestamp" = t."timestamp"
"""


def _sql_lineitem_daily() -> str:
    c = LINEITEM_LATE
    return O.upsert_parity_sql(O.lineitem_measures(), c.granularity, c.allowed_lateness,
                               align=c.align)


def _sql_lateness_summary(g, lat, measures=None) -> str:
    measures = measures or O.events_dense()
    return f"""WITH {O.classify_cte(measures, g, lat)},
fc AS (SELECT object_id, max(ts_ms) AS fta FROM cl GROUP BY object_id),
w AS (SELECT DISTINCT object_id, ws_ms FROM cl WHERE status <> 'late')
SELECT status AS metric, count(*) AS n FROM cl GROUP BY status
UNION ALL
SELECT CASE WHEN w.ws_ms <= fc.fta - {(g + lat) * 60000} THEN 'closed_windows' ELSE 'open_windows' END,
       count(*) FROM w JOIN fc USING (object_id) GROUP BY 1"""


ORACLE_SQL = {
    "parse_valid": f"""SELECT object_id, unit, ts_ms, {O.r6('value')} AS value, arr_major, arr_minor
FROM ({O.events_sparse(float32=True)}) q WHERE unit IN {O.TARGET}""",
    "parse_reject_reasons": f"""SELECT 'unit' AS reason, count(*) AS n
FROM ({O.events_sparse()}) q WHERE unit NOT IN {O.TARGET} GROUP BY 1""",
    "unit_filter": f"""SELECT unit, unit IN {O.TARGET} AS is_target, unit IN {O.ADV} AS with_std,
  count(*) AS n FROM ({O.events_sparse()}) q GROUP BY unit""",
    "window_start_15": _sql_window_start(15),
    "window_start_25": _sql_window_start(25),
    "window_start_1440": _sql_window_start(1440),
    "format_window_start": f"""SELECT strftime(make_timestamp({O.ws(15)} * 1000), '%Y-%m-%dT%H:%M:%SZ')
  AS window_start, count(*) AS n FROM ({O.lineitem_measures()}) q GROUP BY 1""",
    "date_key_month": _sql_date_key(60),
    "date_key_halfyear": _sql_date_key(1440),
    "rollup_15m": O.rollup_sql(O.events_dense(), 15),
    "rollup_60m": O.rollup_sql(O.events_dense(), 60),
    "rollup_multi_granularity": " UNION ALL ".join(
        f"({O.rollup_sql(O.events_dense(), g)})" for g in (15, 60, 1440)),
    "rollup_last_tie": _sql_rollup_cols(O.rollup_sql(O.lineitem_measures(), 60),
                                        ["minutes", "object_id", "date", "timestamp", "count",
                                         "last", "last_ts"]),
    "rollup_kstate": _sql_rollup_cols(O.rollup_sql(O.events_dense(), 60),
                                      ["minutes", "object_id", "date", "timestamp", "count", "k",
                                       "k_sum", "k_sum_2", "std"]),
    "rollup_basic_vs_advanced": O.rollup_sql(O.events_sparse(), 60),
    "rollup_epoch_align_daily": O.rollup_sql(O.lineitem_measures(), 1440, align="epoch"),
    "rollup_json_60m": O.rollup_sql(O.events_sparse(float32=True), 60),
    "time_advance": f"""SELECT object_id, max(ts_ms) AS time_advance, count(*) AS records
FROM ({O.events_sparse()}) q WHERE unit IN {O.TARGET} GROUP BY object_id""",
    "classify_arrivals": f"""WITH {O.classify_cte(O.events_dense(), 60, 30)}
SELECT object_id, arr_major, arr_minor, ts_ms, ws_ms, ta_ms, status FROM cl""",
    "classify_sparse": f"""WITH {O.classify_cte(O.events_sparse(), 15, 5)}
SELECT status, count(*) AS n FROM cl GROUP BY status""",
    "lateness_dense_15_5": _sql_lateness_summary(15, 5),
    "lateness_dense_25_5": _sql_lateness_summary(25, 5),
    "lateness_dense_60_0": _sql_lateness_summary(60, 0),
    "lateness_dense_1440_0": _sql_lateness_summary(1440, 0),
    "emissions_flush0": _sql_emissions(False),
    "flush_at_end": _sql_emissions(True),
    "open_windows_at_end": f"""WITH {O.classify_cte(O.events_dense(), 60, 30)},
acc AS (SELECT * FROM cl WHERE status <> 'late'),
st0 AS ({O.window_stats_sql('acc', 60)}),
fc AS (SELECT object_id, max(ts_ms) AS fta FROM cl GROUP BY object_id),
st AS (SELECT st0.* FROM st0 JOIN fc USING (object_id) WHERE st0.ws_ms > fc.fta - {90 * 60000})
SELECT {O.final_cols(60)} FROM st""",
    "emissions_multi_granularity": " UNION ALL ".join(
        f"({_sql_emissions(False, c.granularity, c.allowed_lateness)})" for c in MULTI_LATE),
    "upsert_multi_granularity": " UNION ALL ".join(
        f"({O.upsert_parity_sql(O.events_dense(), c.granularity, c.allowed_lateness)})"
        for c in MULTI_LATE),
    "upsert_actions": _sql_upsert_actions(),
    "upsert_final_parity": O.upsert_parity_sql(O.events_dense(), 60, 30),
    "upsert_final_combine": _sql_upsert_combine(),
    "lineitem_daily_by_supplier": _sql_lineitem_daily(),
    "stream_rollup": O.upsert_parity_sql(O.events_dense(), 60, 30),
    "rollup_daily_from_15m": _sql_coarser(15, 1440),
    "target_read_by_keys": _sql_read_by_keys(),
    "stream_multi_granularity": " UNION ALL ".join(
        f"({_sql_emissions(False, c.granularity, c.allowed_lateness)})" for c in MULTI_LATE),
    "parse_bad_input": _sql_bad_input(),
    "history_arrival_index": f"""SELECT object_id, unit, ts_ms, {O.r6('value')} AS value,
  row_number() OVER (ORDER BY arr_major, arr_minor) - 1 AS place, CASE WHEN unit NOT IN {O.TARGET} THEN 'unit' END AS reason
FROM ({O.events_sparse(float32=True)}) q""",
    "emissions_cadence": _sql_cadence(),
    "emissions_idle_timeout": _sql_emission_rows(_idle_cte(), IDLE.granularity),
    "upsert_recreated_windows": _sql_recreated(actions=False),
    "upsert_recreated_windows_actions": _sql_recreated(actions=True),
    "stream_emissions_cadence": _sql_cadence(),
    "upsert_onto_stored": _sql_stored(actions=False),
    "upsert_onto_stored_actions": _sql_stored(actions=True),
}
