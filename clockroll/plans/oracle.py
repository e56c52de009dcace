"""DuckDB SQL that states each registered query directly from its definition
(ordered aggregates, window frames, CASE rules) -- an independent check of the
Spark plans, which compute the same results with partial aggregates and joins."""

from __future__ import annotations

ADV = "('%', 'A', 'ppm', 'V', 'W', '°C')"
TARGET = "('lx', 'm/s', '%', 'A', 'ppm', 'V', 'W', '°C')"
ARR = "arr_major, arr_minor"


def r6(x: str) -> str:
    """Round to 6 digits; a rounded zero is +0.0 (no negative zero)."""
    return f"(CASE WHEN round({x}, 6) = 0 THEN 0.0 ELSE round({x}, 6) END)"


def events_sparse(float32: bool = False) -> str:
    val = "CAST(CAST(value AS FLOAT) AS DOUBLE)" if float32 else "value"
    return f"""SELECT CAST(user_id AS INTEGER) AS object_id,
  CASE event_type WHEN 'click' THEN 'V' WHEN 'view' THEN 'lx' WHEN 'purchase' THEN 'W'
    WHEN 'signup' THEN 'm/s' WHEN 'error' THEN 'kWh' END AS unit,
  (epoch_us(ts) // 1000) AS ts_ms, {val} AS value,
  epoch_us(ts) + CAST(json_extract_string(props, '$.k') AS BIGINT) * 60000000 AS arr_major,
  event_id AS arr_minor
FROM events"""


def events_dense() -> str:
    return """SELECT CAST(1 + user_id % 8 AS INTEGER) AS object_id,
  CASE WHEN event_type = 'error' THEN 'kWh'
       ELSE ['V', 'lx', 'W', 'm/s', '°C', '%'][((1 + user_id % 8) % 6) + 1] END AS unit,
  (epoch_us(ts) // 1000) AS ts_ms, value,
  epoch_us(ts) + CAST(json_extract_string(props, '$.k') AS BIGINT) * 60000000 AS arr_major,
  event_id AS arr_minor
FROM events"""


def lineitem_measures() -> str:
    return """SELECT CAST(l_suppkey AS INTEGER) AS object_id, 'W' AS unit,
  (epoch_us(l_shipdate) // 1000) AS ts_ms, l_quantity AS value,
  l_orderkey AS arr_major, CAST(l_linenumber AS BIGINT) AS arr_minor
FROM lineitem"""


def ws(g: int, align: str = "hour", col: str = "ts_ms") -> str:
    if align == "epoch":
        w = g * 60000
        return f"({col} - ({col} % {w}))"
    return f"({col} - ({col} % 3600000) + ((({col} % 3600000) // 60000) // {g}) * {g * 60000})"


def date_key(g: int, col: str = "ws_ms") -> str:
    t = f"make_timestamp({col} * 1000)"
    if g <= 60:
        return f"strftime({t}, '%Y-%m')"
    return f"(strftime({t}, '%Y') || CASE WHEN month({t}) <= 6 THEN '-01' ELSE '-12' END)"


def ts_of(col: str = "ws_ms") -> str:
    return f"make_timestamp({col} * 1000)"


def window_stats_sql(src: str, g: int, keys_extra: str = "") -> str:
    """Window statistics straight from the definitions, over CTE ``src`` having
    object_id, ws_ms, unit, ts_ms, value, arr_major, arr_minor."""
    return f"""SELECT {g} AS minutes, object_id, ws_ms{keys_extra},
    count(*) AS n, sum(value) AS s, min(value) AS mn, max(value) AS mx,
    max(ts_ms) AS lts,
    first(value ORDER BY ts_ms DESC, {ARR}) AS lst,
    first(value ORDER BY {ARR}) AS k0,
    first(unit ORDER BY {ARR}) IN {ADV} AS adv,
    sum(value - kf) AS ks, sum((value - kf) * (value - kf)) AS ks2
  FROM (SELECT *, first_value(value) OVER (PARTITION BY object_id, ws_ms{keys_extra} ORDER BY {ARR}) AS kf
        FROM {src}) z
  GROUP BY object_id, ws_ms{keys_extra}"""


def final_cols(g: int, stats: str = "st") -> str:
    return f"""minutes, object_id, {date_key(g)} AS date, {ts_of()} AS "timestamp",
  n AS "count", {r6('s')} AS "sum", {r6('mn')} AS "min", {r6('mx')} AS "max",
  {r6('s / n')} AS mean,
  {r6('CASE WHEN lts > 0 THEN lst ELSE 0.0 END')} AS "last", greatest(lts, 0) AS last_ts,
  {r6('CASE WHEN adv THEN k0 END')} AS k, {r6('CASE WHEN adv THEN ks END')} AS k_sum,
  {r6('CASE WHEN adv THEN ks2 END')} AS k_sum_2,
  {r6('CASE WHEN adv THEN sqrt(greatest((ks2 - ks * ks / n) / n, 0.0)) END')} AS std"""


def rollup_sql(measures: str, g: int, align: str = "hour", filter_target: bool = True) -> str:
    where = f"WHERE unit IN {TARGET}" if filter_target else ""
    return f"""WITH m AS (SELECT *, {ws(g, align)} AS ws_ms FROM ({measures}) q {where}),
st AS ({window_stats_sql('m', g)})
SELECT {final_cols(g)} FROM st"""


def classify_cte(measures: str, g: int, lateness: int, align: str = "hour") -> str:
    """CTE chain ending in ``cl``: every target measure with ws_ms, ta_ms, opened, status."""
    L = lateness * 60000
    SL = (g + lateness) * 60000
    return f"""m AS (SELECT *, {ws(g, align)} AS ws_ms FROM ({measures}) q WHERE unit IN {TARGET}),
c AS (SELECT *, max(ts_ms) OVER (PARTITION BY object_id ORDER BY {ARR}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ta_ms FROM m),
o AS (SELECT *, (ta_ms IS NULL OR ts_ms >= ta_ms - {L}) AS on_time FROM c),
p AS (SELECT *, coalesce(bool_or(on_time) OVER (PARTITION BY object_id, ws_ms ORDER BY {ARR}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS opened FROM o),
cl AS (SELECT *, CASE WHEN on_time THEN 'on_time'
                      WHEN opened AND ws_ms > ta_ms - {SL} THEN 'late_open'
                      ELSE 'late' END AS status FROM p)"""


def emissions_cte(measures: str, g: int, lateness: int, flush_at_end: bool = False,
                  align: str = "hour") -> str:  # noqa: D401
    """CTE chain ending in ``em`` (emission rows, unrounded) after ``classify_cte``."""
    SL = (g + lateness) * 60000
    keep = "" if flush_at_end else f"WHERE st.ws_ms <= fc.fta - {SL}"
    return f"""{classify_cte(measures, g, lateness, align)},
acc AS (SELECT * FROM cl WHERE status <> 'late'),
st AS ({window_stats_sql('acc', g)}),
fc AS (SELECT object_id, max(ts_ms) AS fta FROM cl GROUP BY object_id),
emc AS (SELECT st.* FROM st JOIN fc USING (object_id) {keep}),
em AS (
  SELECT minutes, object_id, ws_ms, n, s, mn, mx, lts, lst, k0, adv, ks, ks2,
         'closed' AS kind, 1 AS phase, CAST(NULL AS BIGINT) AS arr_major,
         CAST(NULL AS BIGINT) AS arr_minor, CAST(NULL AS DOUBLE) AS v
  FROM emc
  UNION ALL
  SELECT {g}, object_id, ws_ms, 1, value, value, value, ts_ms, value, value,
         unit IN {ADV}, 0.0, 0.0, 'late', CASE WHEN opened THEN 2 ELSE 0 END,
         arr_major, arr_minor, value
  FROM cl WHERE status = 'late')"""


def upsert_parity_sql(measures: str, g: int, lateness: int, align: str = "hour") -> str:
    """Final target rows after applying the emissions to an empty target, with the
    read-compare-write rules spelled out per key: late runs before the closed emission
    (B), the closed emission (C), late runs after it (A)."""
    return f"""WITH {emissions_cte(measures, g, lateness, align=align)},
b AS (SELECT object_id, ws_ms, count(*) AS n, sum(v) AS s, min(v) AS mn, max(v) AS mx,
        max(lts) AS lts, first(v ORDER BY lts DESC, {ARR}) AS lst,
        first(v ORDER BY {ARR}) AS k0, first(adv ORDER BY {ARR}) AS adv,
        list(v) AS vs
      FROM em WHERE kind = 'late' AND phase = 0 GROUP BY object_id, ws_ms),
cc AS (SELECT * FROM em WHERE kind = 'closed'),
a AS (SELECT object_id, ws_ms, count(*) AS n, sum(v) AS s, min(v) AS mn, max(v) AS mx,
        max(lts) AS lts, first(v ORDER BY lts DESC, {ARR}) AS lst, list(v) AS vs
      FROM em WHERE kind = 'late' AND phase = 2 GROUP BY object_id, ws_ms),
keys AS (SELECT DISTINCT object_id, ws_ms FROM em),
base AS (
  SELECT keys.object_id, keys.ws_ms,
    -- state after B and C: C replaces the B-state only if it has more records
    CASE WHEN cc.n IS NOT NULL AND (b.n IS NULL OR b.n < cc.n) THEN 'C'
         WHEN b.n IS NOT NULL THEN 'B' END AS src,
    b.n AS bn, b.s AS bs, b.mn AS bmn, b.mx AS bmx, b.lts AS blts, b.lst AS blst, b.k0 AS bk,
    b.adv AS badv, b.vs AS bvs,
    cc.n AS cn, cc.s AS cs, cc.mn AS cmn, cc.mx AS cmx, cc.lts AS clts, cc.lst AS clst,
    cc.k0 AS ck, cc.adv AS cadv, cc.ks AS cks, cc.ks2 AS cks2,
    a.n AS an, a.s AS as_, a.mn AS amn, a.mx AS amx, a.lts AS alts, a.lst AS alst, a.vs AS avs
  FROM keys LEFT JOIN b USING (object_id, ws_ms) LEFT JOIN cc USING (object_id, ws_ms)
            LEFT JOIN a USING (object_id, ws_ms)),
s1 AS (
  SELECT object_id, ws_ms,
    CASE src WHEN 'C' THEN cn ELSE bn END AS n0,
    CASE src WHEN 'C' THEN cs ELSE bs END AS s0,
    CASE src WHEN 'C' THEN cmn ELSE bmn END AS mn0,
    CASE src WHEN 'C' THEN cmx ELSE bmx END AS mx0,
    CASE src WHEN 'C' THEN clts ELSE blts END AS lts0,
    CASE src WHEN 'C' THEN clst ELSE blst END AS lst0,
    CASE src WHEN 'C' THEN (CASE WHEN cadv THEN ck END)
             ELSE (CASE WHEN badv THEN bk END) END AS k,
    CASE src WHEN 'C' THEN cks ELSE list_sum(list_transform(bvs, lambda x: x - bk)) END AS ks0,
    CASE src WHEN 'C' THEN cks2
             ELSE list_sum(list_transform(bvs, lambda x: (x - bk) * (x - bk))) END AS ks20,
    an, as_, amn, amx, alts, alst, avs
  FROM base),
fin AS (
  SELECT object_id, ws_ms,
    n0 + coalesce(an, 0) AS n, s0 + coalesce(as_, 0.0) AS s,
    least(mn0, coalesce(amn, mn0)) AS mn, greatest(mx0, coalesce(amx, mx0)) AS mx,
    CASE WHEN alts IS NOT NULL AND lts0 < alts THEN alst ELSE lst0 END AS lst,
    CASE WHEN alts IS NOT NULL AND lts0 < alts THEN alts ELSE lts0 END AS lts,
    k,
    CASE WHEN k IS NOT NULL THEN ks0 + coalesce(list_sum(list_transform(avs, lambda x: x - k)), 0.0) END AS ks,
    CASE WHEN k IS NOT NULL THEN ks20 + coalesce(list_sum(list_transform(avs, lambda x: (x - k) * (x - k))), 0.0) END AS ks2
  FROM s1)
SELECT {g} AS minutes, object_id, {date_key(g)} AS date, {ts_of()} AS "timestamp",
  n AS "count", {r6('s')} AS "sum", {r6('mn')} AS "min", {r6('mx')} AS "max",
  {r6('s / n')} AS mean, {r6('lst')} AS "last", lts AS last_ts, {r6('k')} AS k,
  {r6('ks')} AS k_sum, {r6('ks2')} AS k_sum_2,
  {r6('CASE WHEN k IS NOT NULL THEN sqrt(greatest((ks2 - ks * ks / n) / n, 0.0)) END')} AS std
FROM fin"""


def cadence_cte(measures: str, g: int, lateness: int, flush_every: int) -> str:
    """CTE chain ending in ``em`` for a cleanup cadence: cleanups follow one another as a recursion
    over the on-time records, and a window closes at the first one that finds it due."""
    L, SL, FE = lateness * 60000, (g + lateness) * 60000, flush_every * 60000
    return f"""m AS (SELECT *, {ws(g)} AS ws_ms, row_number() OVER (PARTITION BY object_id ORDER BY {ARR}) AS rn
      FROM ({measures}) q WHERE unit IN {TARGET}),
c AS (SELECT *, max(ts_ms) OVER (PARTITION BY object_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ta_ms,
      max(ts_ms) OVER (PARTITION BY object_id ORDER BY rn) AS now_ms FROM m),
o AS (SELECT *, (ta_ms IS NULL OR ts_ms >= ta_ms - {L}) AS on_time FROM c),
clocks AS (SELECT object_id, now_ms, min(rn) AS rn FROM o WHERE on_time GROUP BY object_id, now_ms),
nxt AS (SELECT a.object_id, a.now_ms, min(b.now_ms) AS next_ms, min(b.rn) AS next_rn FROM clocks a JOIN clocks b
        ON a.object_id = b.object_id AND a.now_ms + {FE} <= b.now_ms GROUP BY a.object_id, a.now_ms),
cleanups AS (
  SELECT object_id, now_ms, rn FROM clocks WHERE rn = 1
  UNION ALL
  SELECT n.object_id, n.next_ms, n.next_rn FROM cleanups k JOIN nxt n ON n.object_id = k.object_id AND n.now_ms = k.now_ms),
w AS (SELECT object_id, ws_ms, min(rn) FILTER (WHERE on_time) AS born FROM o GROUP BY object_id, ws_ms),
shut AS (SELECT w.object_id, w.ws_ms, min(k.rn) AS shut FROM w JOIN cleanups k
         ON k.object_id = w.object_id AND k.rn > 1 AND k.now_ms >= w.ws_ms + {SL} GROUP BY w.object_id, w.ws_ms),
f AS (SELECT o.*, born, shut, on_time OR coalesce(born < rn AND (shut IS NULL OR rn < shut), false) AS inside
      FROM o JOIN w USING (object_id, ws_ms) LEFT JOIN shut USING (object_id, ws_ms)),
acc AS (SELECT * FROM f WHERE inside AND shut IS NOT NULL),
st AS ({window_stats_sql('acc', g)}),
em AS (
  SELECT minutes, object_id, ws_ms, n, s, mn, mx, lts, lst, k0, adv, ks, ks2, 'closed' AS kind, 1 AS phase,
         CAST(NULL AS BIGINT) AS arr_major, CAST(NULL AS BIGINT) AS arr_minor FROM st
  UNION ALL
  SELECT {g}, object_id, ws_ms, 1, value, value, value, ts_ms, value, value, unit IN {ADV}, 0.0, 0.0, 'late',
         CASE WHEN born < rn THEN 2 ELSE 0 END, arr_major, arr_minor FROM f WHERE NOT inside)"""


def idle_cte(measures: str, g: int, lateness: int, timeout: int) -> str:
    """CTE chain ending in ``em`` with an idle timeout (cleanup after every record): a pause between two
    arrivals ends a generation, and a window is opened and closed once per generation."""
    L, SL = lateness * 60000, (g + lateness) * 60000
    return f"""m AS (SELECT *, {ws(g)} AS ws_ms, coalesce(arr_major - lag(arr_major) OVER (PARTITION BY object_id ORDER BY {ARR}) >= {timeout * 60_000_000}, false) AS paused
      FROM ({measures}) q WHERE unit IN {TARGET}),
c AS (SELECT *, sum(paused::INT) OVER (PARTITION BY object_id ORDER BY {ARR}) AS gen,
      max(ts_ms) OVER (PARTITION BY object_id ORDER BY {ARR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ta_ms FROM m),
o AS (SELECT *, (ta_ms IS NULL OR ts_ms >= ta_ms - {L}) AS on_time FROM c),
p AS (SELECT *, coalesce(bool_or(on_time) OVER (PARTITION BY object_id, ws_ms, gen ORDER BY {ARR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS opened FROM o),
cl AS (SELECT *, on_time OR (opened AND ws_ms > ta_ms - {SL}) AS inside FROM p),
fin AS (SELECT object_id, max(ts_ms) AS fta, max(gen) AS last_gen FROM cl GROUP BY object_id),
acc AS (SELECT * FROM cl WHERE inside),
st AS ({window_stats_sql('acc', g, ', gen')}),
nth AS (SELECT st.*, row_number() OVER (PARTITION BY object_id, ws_ms ORDER BY gen) AS nth, (gen < last_gen OR ws_ms <= fta - {SL}) AS closed FROM st JOIN fin USING (object_id)),
late AS (SELECT cl.*, (SELECT count(*) FROM nth w WHERE w.object_id = cl.object_id AND w.ws_ms = cl.ws_ms AND w.gen < cl.gen) AS earlier FROM cl WHERE NOT inside),
em AS (
  SELECT minutes, object_id, ws_ms, n, s, mn, mx, lts, lst, k0, adv, ks, ks2, 'closed' AS kind, CAST(2 * nth - 1 AS INTEGER) AS phase,
         CAST(NULL AS BIGINT) AS arr_major, CAST(NULL AS BIGINT) AS arr_minor FROM nth WHERE closed
  UNION ALL
  SELECT {g}, object_id, ws_ms, 1, value, value, value, ts_ms, value, value, unit IN {ADV}, 0.0, 0.0, 'late',
         CAST(2 * (earlier + opened::INT) AS INTEGER), arr_major, arr_minor FROM late)"""


def two_batches_sql(measures: str, g: int, lateness: int, actions: bool) -> str:
    """Two batches (even and odd ``arr_minor``) applied in turn, emission by emission, as a recursion
    over each key's emissions: a stored row takes a late record in, and is replaced by a closed
    window that counts more records."""
    half = [f"SELECT * FROM ({measures}) z WHERE arr_minor % 2 = {i}" for i in (0, 1)]
    parts = [f"SELECT {i} AS batch, * FROM (WITH {emissions_cte(half[i], g, lateness)} SELECT * FROM em)" for i in (0, 1)]
    return applied_sql(f"{parts[0]} UNION ALL {parts[1]}", g, actions)


def applied_sql(emitted: str, g: int, actions: bool) -> str:
    """The target after ``emitted`` (batch and the columns of ``em``) was applied in order, or its counters by batch."""
    row = "n, s, mn, mx, lts, lst, CASE WHEN adv THEN k0 END AS k, ks, ks2"
    head = f"""WITH RECURSIVE allem AS ({emitted}),
e AS (SELECT batch, object_id, ws_ms, kind, {row}, row_number() OVER (PARTITION BY object_id, ws_ms ORDER BY batch, phase, arr_major, arr_minor) AS i FROM allem),
r AS (
  SELECT e.* EXCLUDE (kind), CASE WHEN kind = 'late' THEN 'late_first' ELSE 'normal' END AS act FROM e WHERE i = 1
  UNION ALL
  SELECT e.batch, e.object_id, e.ws_ms,
    CASE WHEN late THEN r.n + 1 WHEN r.n < e.n THEN e.n ELSE r.n END, CASE WHEN late THEN r.s + e.s WHEN r.n < e.n THEN e.s ELSE r.s END,
    CASE WHEN late THEN least(r.mn, e.mn) WHEN r.n < e.n THEN e.mn ELSE r.mn END, CASE WHEN late THEN greatest(r.mx, e.mx) WHEN r.n < e.n THEN e.mx ELSE r.mx END,
    CASE WHEN late THEN greatest(r.lts, e.lts) WHEN r.n < e.n THEN e.lts ELSE r.lts END,
    CASE WHEN late AND r.lts < e.lts THEN e.lst WHEN late THEN r.lst WHEN r.n < e.n THEN e.lst ELSE r.lst END,
    CASE WHEN late THEN r.k WHEN r.n < e.n THEN e.k ELSE r.k END,
    CASE WHEN late THEN r.ks + (e.s - r.k) WHEN r.n < e.n THEN e.ks ELSE r.ks END,
    CASE WHEN late THEN r.ks2 + (e.s - r.k) * (e.s - r.k) WHEN r.n < e.n THEN e.ks2 ELSE r.ks2 END,
    e.i, CASE WHEN late THEN 'late_update' WHEN r.n < e.n THEN 'override' ELSE 'skip' END
  FROM r JOIN (SELECT *, kind = 'late' AS late FROM e) e ON e.object_id = r.object_id AND e.ws_ms = r.ws_ms AND e.i = r.i + 1)
"""
    if actions:
        one = lambda *a: f"count(*) FILTER (WHERE act IN ({', '.join(repr(x) for x in a)}))"
        return head + f"""SELECT batch, {one('normal')} AS rec_normal, {one('late_first', 'late_update')} AS rec_late, {one('late_first')} AS rec_late_first,
  {one('late_update')} AS rec_late_update, {one('override')} AS rec_override, {one('skip')} AS rec_skip FROM r GROUP BY batch"""
    return head + f"""SELECT {g} AS minutes, object_id, {date_key(g)} AS date, {ts_of()} AS "timestamp",
  n AS "count", {r6('s')} AS "sum", {r6('mn')} AS "min", {r6('mx')} AS "max", {r6('s / n')} AS mean, {r6('lst')} AS "last", lts AS last_ts,
  {r6('k')} AS k, {r6('CASE WHEN k IS NOT NULL THEN ks END')} AS k_sum, {r6('CASE WHEN k IS NOT NULL THEN ks2 END')} AS k_sum_2,
  {r6('CASE WHEN k IS NOT NULL THEN sqrt(greatest((ks2 - ks * ks / n) / n, 0.0)) END')} AS std
FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY object_id, ws_ms ORDER BY i DESC) = 1)"""
